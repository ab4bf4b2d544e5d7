"""Text scores against the same model in memory."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from fleetspark.llm import lm
from fleetspark.llm.common import table, words_of

SF = "/root/testdata/sf0.001"


def in_memory(texts: dict[int, str]) -> tuple[dict[int, float], lm.SuffixTree]:
    streams = {i: lm.stream(words_of(t.encode())).tobytes() for i, t in texts.items()}
    counts: dict[bytes, Counter] = defaultdict(Counter)
    for i, s in streams.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for at in range(lm.DEPTH, len(s)):
                for depth in range(lm.DEPTH + 1):
                    counts[s[at - depth : at]][s[at]] += 1

    def row(context: bytes) -> np.ndarray:
        return np.array([counts[context][s] for s in range(256)], float)

    tree = lm.SuffixTree(row(b""))
    for context in sorted(counts, key=lambda c: (len(c), c)):
        if context and sum(counts[context].values()) >= lm.LEAST_COUNT:
            tree.add(context, row(context))
    return {
        i: sum(tree.log[tree.state(s[at - lm.DEPTH : at])][s[at]] for at in range(lm.DEPTH, len(s)))
        for i, s in streams.items()
    }, tree


@pytest.mark.parametrize("hot", [lm.HOT_GRAMS, 100])
def test_scores_equal_the_model_in_memory(spark, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT_GRAMS", hot)
    docs = table(spark, SF, "documents").orderBy("doc_id").limit(60)
    expected, _ = in_memory({r["doc_id"]: r["text"] or "" for r in docs.collect()})
    found = {r["doc_id"]: r["score"] for r in lm.score_texts(docs).collect()}
    assert found == pytest.approx(expected)


def test_rare_contexts_are_kept_in_a_large_corpus(spark):
    """'qz' is always followed by 'x', 40 times in 2.4 million symbols: a share of 1.7e-5."""
    rows = [(i, "abcdefgh ijklmnop " * 670) for i in range(200)] + [(1000 + i, "qzx") for i in range(40)]
    rows += [(2000, "qzx"), (2001, "qzy")]
    found = {r["doc_id"]: r["score"] for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[2000] > -3.0 and found[2001] < found[2000] - 2


def test_a_context_is_tested_against_its_longest_kept_suffix():
    tree = lm.SuffixTree(np.full(256, 1000.0))
    tree.add(b"b", np.full(256, 10.0))  # as its parent: not kept
    following = np.zeros(256)
    following[65] = 100
    tree.add(b"ab", following)
    assert 10 ** tree.log[tree.state(b"xab")][65] > 0.9
    assert np.array_equal(tree.log[tree.state(b"xb")], tree.log[0])  # only a step on the way


@pytest.mark.parametrize("held", [lm.HELD_GRAMS, 3_000])
def test_counts_by_buckets(spark, monkeypatch, held):
    monkeypatch.setattr(lm, "HELD_GRAMS", held)
    texts = [r["text"] or "" for r in table(spark, SF, "documents").orderBy("doc_id").limit(60).collect()]
    batch = pa.RecordBatch.from_pydict({"learnt": [i % 7 != 2 for i in range(len(texts))], "text": texts})
    sent = pa.Table.from_batches(lm._counted([batch, batch]))
    wanted = {kind: Counter() for kind in (lm.WORD, lm.LEARNT, lm.ALL)}
    for i, text in enumerate(texts):
        words = words_of(text.encode())
        grams = lm._grams(lm.stream(words)).tolist()
        wanted[lm.ALL].update(grams * 2)
        if i % 7 != 2:
            wanted[lm.LEARNT].update(grams * 2)
            wanted[lm.WORD].update([int(lm.WordHashes().of([w]).view(np.int64)[0]) for w in [*words, lm.END_TOKEN]] * 2)
    found = {kind: Counter() for kind in wanted}
    for bucket in set(sent["bucket"].to_pylist()):
        for row in lm._summed(sent.filter(pc.equal(sent["bucket"], bucket))).to_pylist():
            assert row["key"] not in found[row["kind"]]
            found[row["kind"]][row["key"]] = row["n"]
    assert found == wanted


def test_a_gram_travels_in_few_bytes():
    """300,000 grams, five to a context; a row of Spark's for each takes 40 before compression."""
    dice = np.random.default_rng(3)
    contexts = np.repeat(dice.choice(1 << 40, 60_000, replace=False), 5) << 8
    keys = np.unique(contexts | dice.integers(256, size=len(contexts)))
    sent = lm._dealt(lm.LEARNT, keys, np.ones(len(keys), np.int64)).to_pylist()
    assert len(sent) == 1 << lm.BUCKET_BITS
    assert sum(len(row["keys"]) + len(row["counts"]) for row in sent) < 5 * len(keys)


def test_texts_of_a_slice_together():
    texts = [b"", b" \n", b" A b", b"a b  a\n", b"\x0bz\x0cZ\r\nc ", "\u00c9 \u00e9 a".encode(), b"\xff a", b"a" * 300_000]
    for text, symbols in zip(texts, lm.streams_of(texts), strict=True):
        assert np.array_equal(symbols, lm.stream(words_of(text)))
    keys = {word: int(lm.WordHashes().of([word]).view(np.int64)[0]) for word in (b"a", b"z", lm.END_TOKEN)}
    for frequent in ({keys[b"a"]: 2.0, keys[b"z"]: 3.0}, {keys[lm.END_TOKEN]: 1.0}, {}):
        found = [column.tolist() for column in lm.text_words(texts, frequent)[:3]]
        rare, times = (column.to_pylist() for column in lm.text_words(texts, frequent)[3:])
        for i, text in enumerate(texts):
            tally = Counter(int(lm.WordHashes().of([w]).view(np.int64)[0]) for w in [*words_of(text), lm.END_TOKEN])
            assert found[0][i] == tally.total()
            assert found[1][i] == sum(n for key, n in tally.items() if key in frequent)
            assert found[2][i] == sum(n * frequent.get(key, 0.0) for key, n in tally.items())
            assert dict(zip(rare[i], times[i])) == {key: n for key, n in tally.items() if key not in frequent}


def test_a_hot_gram_is_found_at_any_try():
    keys = np.unique(np.random.default_rng(5).integers(1 << 56, size=20_000))
    hot = lm.HotGrams(keys[::2], np.arange(len(keys[::2])) - 1e6)
    scores, rest = hot.look_up(keys)
    assert set(rest[rest % 2 == 0].tolist()) == set(np.flatnonzero(scores == 0).tolist()) - set(range(1, len(keys), 2))
    assert np.array_equal(rest, np.flatnonzero(scores == 0)) and np.isin(np.arange(1, len(keys), 2), rest).all()
    assert all(scores[i] == i // 2 - 1e6 for i in range(0, len(keys), 2) if scores[i])
