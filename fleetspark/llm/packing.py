"""Cost-balanced packing of token ids into sequences of a fixed size.

A document's attention cost is estimated as a linear plus a quadratic term of its tokens. Documents
are dealt by hash into groups of a bounded token total. In each group, as many sequences are
opened as its tokens fill, and documents go in descending order of cost to the sequence of the
lowest cost that still has room for them. What fits nowhere whole is cut over the rooms left, the
lowest cost first. The tokens short of a full sequence fill sequences of powers of two, which are
not padded, so no padding is left.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import Workspace, blobs, id_text, listed, sliced

SIZE = 2048
END = 1
GROUP_TOKENS = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / SIZE
CACHE_WORDS = 400_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, group long, "
    "sequence long, offset long"
)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    # Spark runs a task on each core; threads of the tokenizer would compete with them.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


# Words of printable ASCII and Latin-1 alone: their lower case and normal form are the same
# everywhere, and none holds a special token's opening.
PLAIN = "^[!-~\u00a1-\u00ff]*$"


def _byte_letters() -> dict[int, str]:
    """A printable character for each byte, as byte-level tokenizers write them."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


@lru_cache(maxsize=2)
def _cutter(path: str) -> regex.Pattern | None:
    """The tokenizer's own pattern, or a line feed; none if its steps are not those known here."""
    with open(path, encoding="utf-8") as file:
        steps = json.load(file)
    # Cutting by hand is right for this chain of steps alone.
    normal = [step["type"] for step in (steps["normalizer"] or {}).get("normalizers", [])]
    cuts = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
    known = (
        normal == ["NFC", "Replace", "Lowercase"]
        and [step["type"] for step in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
        and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
    )
    return regex.compile(cuts[0]["pattern"]["Regex"] + r"|\n") if known else None


class WordIds(dict):
    """Token ids of white-space separated words as bytes of unsigned 16-bit integers.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids
    in order. New plain words are cut together by the tokenizer's own pattern, and each new piece is
    given to its merge model once; other words go through the whole tokenizer. A task has its own, so
    that no worker keeps words when its task is over.
    """

    def __init__(self, path: str):
        super().__init__()
        self.path = path
        self.pieces: dict[str, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.letters = _byte_letters()
        self.tokenize = _tokenizer(path).model.tokenize  # `model` is another object each time
        self.cut = _cutter(path)

    def of(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids of distinct words, and the place of each word's. Letters alone are a piece, which the
        pattern takes whole, and are kept as such only."""
        letters = pc.and_(_plain(words), pc.utf8_is_alpha(words)) if self.cut else pc.is_null(words)
        pieces = listed(pc.utf8_lower(words.filter(letters)))
        others = listed(words.filter(pc.invert(letters)).cast(pa.large_binary()))
        self.learn(others)
        self.know(pieces)
        ids = [*map(self.pieces.__getitem__, pieces), *map(self.__getitem__, others)]
        place = np.empty(len(words), np.int64)
        place[np.argsort(pc.invert(letters).to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(words))
        return pa.array(ids, pa.large_binary()), place

    def learn(self, words: list[bytes]) -> None:
        """Every one of the words is known afterwards."""
        if len(self) > CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        if len(self.pieces) > CACHE_WORDS:
            self.older_pieces, self.pieces = self.pieces, {}
        new = [word for word in words if word not in self]
        if self.older:
            self.update({word: self.older[word] for word in new if word in self.older})
            new = [word for word in new if word not in self]
        texts = pa.array(new, pa.large_binary()).cast(pa.large_string())
        plain = _plain(texts) if self.cut else pa.array(np.zeros(len(new), bool))
        tokenizer = _tokenizer(self.path)
        for text in listed(texts.filter(pc.invert(plain))):
            ids = array("H", tokenizer.encode(text, add_special_tokens=False).ids)
            self[text.encode()] = ids.tobytes()
        # Many words are cut at once, each behind a line feed; no piece holds white space.
        words = listed(texts.filter(plain))
        cuts = self.cut.findall("\n".join([*words, ""]).lower()) if words else []
        self.pieces["\n"] = b""
        self.know(cuts)
        parts = list(map(self.pieces.__getitem__, cuts))
        ids, ends = b"".join(parts), np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        ends = ends[[place for place, cut in enumerate(cuts) if cut == "\n"]].tolist()
        self.update(zip(map(str.encode, words), [ids[start:end] for start, end in zip([0, *ends], ends)]))

    def know(self, texts: list[str]) -> None:
        for text in set(texts).difference(self.pieces):
            self.piece(text)

    def piece(self, text: str) -> None:
        """The piece is known afterwards."""
        ids = self.older_pieces.get(text)
        if ids is None:
            shown = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
            ids = array("H", [token.id for token in self.tokenize(shown)]).tobytes()
        self.pieces[text] = ids


def _plain(texts: pa.Array) -> pa.Array:
    return pc.and_not(pc.match_substring_regex(texts, PLAIN), pc.match_substring(texts, "<|"))


def token_ids(texts: list[bytes], path: str, known: WordIds | None = None) -> list[bytes]:
    """Each text's ids and the end id, as little-endian unsigned 16-bit integers."""
    if not texts:
        return []
    if known is None:
        known = WordIds(path)
    # Splits at the ASCII white space that bytes.split knows; an empty word has no ids.
    split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    coded = split.values.dictionary_encode()
    ids, place = known.of(coded.dictionary)
    # Each word's ids in its place: texts' ids lie behind one another.
    ids = ids.take(pa.array(place[coded.indices.to_numpy()]))
    _, ends, ids = ids.buffers()
    ends = np.frombuffer(ends, np.int64) if ends else np.zeros(1, np.int64)
    ids = ids.to_pybytes() if ids else b""
    cuts = ends[split.offsets.to_numpy()].tolist()
    end = np.array([END], np.uint16).tobytes()
    return [ids[start:stop] + end for start, stop in zip(cuts, cuts[1:])]


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (unsigned 16-bit) and tokens of every row; a null text has the end id alone."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        known = WordIds(path)
        for batch in sliced(batches, "text"):
            ids = token_ids(blobs(batch.column("text")), path, known)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ids, pa.binary()),
                    pa.array([len(x) // 2 for x in ids], pa.int64()),
                ],
                ["doc_id", "ids", "tokens"],
            )

    return id_text(docs).mapInArrow(run, "doc_id long, ids binary, tokens long")


def capacities(total: int, size: int = SIZE) -> list[int]:
    """Full sequences, then powers of two, that hold exactly `total` tokens."""
    rest = total % size
    powers = [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    return [size] * (total // size) + powers


def balance(lengths: list[int], size: int = SIZE) -> list[tuple[int, ...]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths.

    Whole sequences are cut off long documents first, as nothing else can share them. Ties in
    cost go to the document that comes first and to the sequence of the smallest number.
    """

    def cost(tokens: int) -> float:
        return LINEAR * tokens + QUADRATIC * tokens * tokens

    pieces: list[tuple[int, ...]] = []
    left = []
    sequence = 0
    for place, length in enumerate(lengths):
        full = length // size
        for part in range(full):
            pieces.append((place, part * size, size, sequence, 0))
            sequence += 1
        if length % size:
            left.append((length % size, place, full * size))
    rooms = capacities(sum(length for length, _, _ in left), size)
    used, costs = [0] * len(rooms), [0.0] * len(rooms)
    ready = [(0.0, i) for i in range(len(rooms))]  # by cost
    waiting: list[tuple[int, int]] = []  # too full for the last document, largest room first
    homeless = []

    def place_piece(place: int, start: int, length: int, best: int) -> None:
        pieces.append((place, start, length, sequence + best, used[best]))
        used[best] += length
        costs[best] += cost(length)

    for length, place, start in sorted(left, key=lambda x: (-x[0], x[1], x[2])):
        while waiting and -waiting[0][0] >= length:
            _, back = heapq.heappop(waiting)
            heapq.heappush(ready, (costs[back], back))
        while ready and rooms[ready[0][1]] - used[ready[0][1]] < length:
            _, full_now = heapq.heappop(ready)
            heapq.heappush(waiting, (used[full_now] - rooms[full_now], full_now))
        if not ready:
            homeless.append((length, place, start))
            continue
        _, best = heapq.heappop(ready)
        place_piece(place, start, length, best)
        heapq.heappush(ready, (costs[best], best))
    open_rooms = sorted((i for i in range(len(rooms)) if used[i] < rooms[i]), key=lambda i: (costs[i], i))
    at = 0
    for length, place, start in homeless:
        while length:
            best = open_rooms[at]
            part = min(length, rooms[best] - used[best])
            place_piece(place, start, part, best)
            start, length = start + part, length - part
            at += used[best] == rooms[best]
    return pieces


def _packed(group: pa.Table) -> pa.Table:
    ids = [x.as_buffer() for x in group["ids"]]
    doc_ids, tokens = group["doc_id"].to_pylist(), group["tokens"].to_pylist()
    # Documents are taken in an order that does not depend on how rows arrived.
    order = sorted(
        range(len(ids)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0, tokens[i], bytes(ids[i]))
    )
    number = group["group"][0].as_py()
    rows = []
    for place, start, length, sequence, offset in balance([tokens[i] for i in order]):
        i = order[place]
        part = np.frombuffer(ids[i], np.uint16)[start : start + length].astype("<u4")
        rows.append(
            (doc_ids[i], start, length, zlib.crc32(part.tobytes()), tokens[i], number, sequence, offset)
        )
    columns = list(zip(*rows))
    names = [field.split()[0] for field in PIECES.split(", ")]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def pack(docs: DataFrame, path: str) -> DataFrame:
    """Pieces of every row: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `path` names a tokenizer file whose ids are below 65,536. Every document ends with the end id, so
    null and empty texts are one piece of one token. Repeated rows are packed once each.
    """
    ws = Workspace(docs.sparkSession, "packing")
    ids = ws.land(tokenized(docs, path), "ids")
    total = ids.agg(F.sum("tokens")).first()[0] or 0
    groups = max(1, -(-total // GROUP_TOKENS))
    # Rows of a landed table keep their place, so a lost task deals them again as before.
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long")
    return (
        ids.withColumn("group", dealt)
        .groupBy("group")
        .applyInArrow(_packed, PIECES)
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("group") * (1 << 32) + F.col("sequence")).alias("sequence_id"), "offset",
        )
    )
