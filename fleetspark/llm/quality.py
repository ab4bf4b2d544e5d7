"""Document quality by Bradley-Terry ranking: pairwise preferences, then a quantile threshold.

A document is described by shares that do not depend on its language: word and line repetition,
character classes, word lengths. Every pair of a preferred and a rejected document asks that the
first scores higher; the logistic loss on feature differences is minimised over pairs. The score
at the quantile given by the share of rejected documents becomes the threshold, and the logistic
function of the distance to it is the published score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import blobs, id_text, in_fold, sliced, words_of

FEATURES = (
    "log_words",
    "short_text",
    "distinct_share",
    "repeat_share",
    "top_word_share",
    "letter_share",
    "symbol_share",
    "bar_share",
    "upper_share",
    "stop_share",
    "log_word_length",
    "line_repeat_share",
    "log_line_length",
    "word_symbol_share",
    "bare_symbol_share",
)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_USUAL = np.zeros(256, bool)
_USUAL[list(b".,;:'\"!?()-")] = True
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _USUAL)


def describe(text: bytes | None) -> list[float]:
    """The features of one whole text; a null text counts as empty, and empty shares are 0."""
    text = text or b""
    words = words_of(text)
    count = len(words)
    if not count:
        return [0.0, 1.0] + [0.0] * (len(FEATURES) - 2)
    chars = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    solid = max(1, int(chars.sum() - chars[_SPACE].sum()))
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    lines = [line for line in text.split(b"\n") if line.strip()]
    bare = sum(n for word, n in tally.items() if len(word) == 1 and not word.isalnum())
    tailed = sum(n for word, n in tally.items() if _SYMBOL[word[-1]])
    return [
        np.log1p(count),
        1.0 if count < 10 else 0.0,
        len(tally) / count,
        repeats / count,
        max(tally.values()) / count,
        chars[_LETTER].sum() / max(1, solid - int(chars[_DIGIT].sum())),
        chars[_SYMBOL].sum() / solid,
        chars[124] / solid,
        chars[_UPPER].sum() / solid,
        (chars[46] + chars[33] + chars[63]) / solid,
        np.log(solid / count),
        1.0 - len(set(lines)) / len(lines),
        np.log1p(count / len(lines)),
        tailed / count,
        bare / count,
    ]


@dataclass(frozen=True)
class Ranking:
    """Weights of standardised features, and the threshold in units of their sum."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        raw = np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights - self.threshold
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -40, 40)))


CONSTANT = Ranking(
    np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), 0.0
)


def bradley_terry(
    rows: np.ndarray, preferred: np.ndarray, rounds: int = 300, pairs: int = 20_000
) -> Ranking:
    """Fit by gradient steps on pairs dealt by a fixed generator, every row in turn.

    Ties need no rule: a pair always joins a preferred with a rejected row. With rows of one kind
    only there is no pair; every document then scores 0.5.
    """
    good, bad = rows[preferred], rows[~preferred]
    if not len(good) or not len(bad):
        return CONSTANT
    mean, scale = rows.mean(0), rows.std(0)
    scale[scale < 1e-9] = 1.0
    good, bad = (np.clip((x - mean) / scale, -8, 8) for x in (good, bad))
    dealt = np.random.default_rng(7)
    count = max(pairs, len(good), len(bad))
    left = np.resize(dealt.permutation(len(good)), count)
    right = dealt.permutation(np.resize(dealt.permutation(len(bad)), count))
    difference = good[left] - bad[right]
    weights, speed = np.zeros(rows.shape[1]), np.zeros(rows.shape[1])
    for _ in range(rounds):
        loss_slope = -1.0 / (1.0 + np.exp(np.clip(difference @ weights, -40, 40)))
        slope = difference.T @ loss_slope / count + 1e-4 * weights
        speed = 0.9 * speed - 0.3 * slope
        weights = weights + speed
    raw = np.concatenate([good @ weights, bad @ weights])
    share = len(bad) / len(raw)
    ordered = np.sort(raw)
    cut = min(max(int(round(share * len(raw))), 1), len(raw) - 1)
    return Ranking(mean, scale, weights, float((ordered[cut - 1] + ordered[cut]) / 2))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    modulus: int | None = 3,
    remainder: int = 1,
    sample: int = 20_000,
) -> Ranking:
    """Learn from labelled documents outside the held-out fold.

    `sample` bounds the labelled rows learnt from: those of the smallest hashed ids. Labels other
    than 0 and 1, and labels of null ids, are left out; repeated labels of an id count once each.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")
    ).where("doc_id IS NOT NULL AND label IN (0, 1)")
    if modulus is not None:
        known = known.where(~in_fold("doc_id", modulus, remainder))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    rows = (
        id_text(docs)
        .join(F.broadcast(chosen), "doc_id")
        .select("text", "label")
        .mapInArrow(_labelled, "features array<double>, label int")
        .toPandas()
    )
    if not len(rows):
        return CONSTANT
    matrix = np.array(rows["features"].tolist(), float)
    order = np.lexsort((rows["label"].to_numpy(), *matrix.T))
    return bradley_terry(matrix[order], rows["label"].to_numpy()[order] == 1)


def _labelled(batches) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        found = [describe(text) for text in blobs(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.list_(pa.float64())), batch.column("label")], ["features", "label"]
        )


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """`doc_id`, `score` for every row; nothing but the text enters a score."""

    def scored(batches) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            rows = np.array([describe(text) for text in blobs(batch.column("text"))], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ranking.scores(rows))], ["doc_id", "score"]
            )

    return id_text(docs).mapInArrow(scored, "doc_id long, score double")


def keep_good(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The rows whose text scores 0.5 or more, with all their columns as they are."""

    def kept(batches) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            rows = np.array([describe(text) for text in blobs(batch.column("text"))], float)
            yield batch.filter(pa.array(ranking.scores(rows) >= 0.5))

    return docs.mapInArrow(kept, docs.schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; see `fit` for the labels."""
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        in_fold("doc_id", 3, 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
