"""Mixing to target weights with soft domain membership, on DataFrame functions alone.

Domains are the label combinations of a labelled table. A naive Bayes classifier over binned text
features and indicative words, counted on the labelled documents, gives every document a posterior
over domains. Rates r >= 0 per document then minimise the squared distance between the expected
domain totals sum(r * tokens * posterior) and their targets, by accelerated projected gradient
steps from r = 1: each step is one aggregate, and only the domain totals reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import Workspace, id_text

DOMAINS = ("clean", "low", "toxic")
SPLIT = r"[\x20\x09-\x0D]+"
LEXICON = 200
LABELLED = 4_000
STEPS = 60
TOLERANCE = 1e-4
BIN_COUNT, FEATURE_COUNT = 10, 5


def domain_of(quality: Column, toxic: Column) -> Column:
    """Index into DOMAINS; null where a label is missing or not 0 or 1."""
    known = quality.isin(0, 1) & toxic.isin(0, 1)
    return F.when(known, F.when(toxic == 1, 2).when(quality == 0, 1).otherwise(0))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), SPLIT), "")


def _share_bin(part: Column, whole: Column) -> Column:
    """0..9, finer near zero; an empty whole is bin 0."""
    share = F.when(whole > 0, part / whole).otherwise(0.0)
    return F.least(F.floor(F.sqrt(share) * 10), F.lit(BIN_COUNT - 1)).cast("int")


def _runs_of(text: Column, marks: str) -> Column:
    return F.size(F.split(text, marks, -1)) - 1


def features(rows: DataFrame, lexicon: list[str]) -> DataFrame:
    """`rows` with `tokens` and `bins`: distinct words, marks, word length, size, known words."""
    known = F.array(*map(F.lit, lexicon)) if lexicon else F.array().cast("array<string>")
    counted = (
        rows.withColumn("words", _words(F.col("text")))
        .withColumn("tokens", F.size("words").cast("long"))
        .withColumn("kinds", F.array_distinct("words"))
    )
    hits = F.size(F.array_intersect("kinds", known))
    bins = F.array(
        _share_bin(F.size("kinds"), F.col("tokens")),
        _share_bin(_runs_of(F.col("text"), r"[#$%&*]+"), F.col("tokens")),
        _share_bin(_runs_of(F.col("text"), r"\|"), F.col("tokens")),
        F.least(F.floor(F.log2(F.col("tokens") + 1) / 2), F.lit(9)).cast("int"),
        F.least(hits, F.lit(9)),
    )
    return counted.withColumn("bins", bins).drop("words", "kinds")


def learn_lexicon(labelled: DataFrame, size: int = LEXICON) -> list[str]:
    """Words most over-represented among toxic documents, at most `size`, ties by word."""
    toxic = F.col("domain") == 2
    totals = labelled.agg(
        F.sum(toxic.cast("int")).alias("yes"), F.sum((~toxic).cast("int")).alias("no")
    ).first()
    if not totals["yes"] or not totals["no"]:
        return []
    rows = (
        labelled.select(toxic.cast("int").alias("yes"), F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
        .groupBy("word")
        .agg(F.sum("yes").alias("yes"), F.count("*").alias("documents"))
        .where("yes >= 5")
        .withColumn("no", F.col("documents") - F.col("yes"))
        .withColumn(
            "odds",
            F.log((F.col("yes") + 0.5) / (totals["yes"] + 1)) - F.log((F.col("no") + 0.5) / (totals["no"] + 1)),
        )
        .where("odds > 2")
        .orderBy(F.desc(F.col("odds") * F.col("yes")), "word")
        .limit(size)
        .collect()
    )
    return [row["word"] for row in rows]


def learn_posterior(labelled: DataFrame) -> np.ndarray:
    """Log weights [1 + FEATURE_COUNT, BIN_COUNT, domains]: priors in the first row's bin 0."""
    counts = np.ones((FEATURE_COUNT, BIN_COUNT, len(DOMAINS)))
    prior = np.ones(len(DOMAINS))
    rows = (
        labelled.select("domain", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("domain", "feature", "bin")
        .count()
        .collect()  # at most domains x features x bins rows
    )
    for row in rows:
        counts[row["feature"], row["bin"], row["domain"]] += row["count"]
        if row["feature"] == 0:
            prior[row["domain"]] += row["count"]
    weights = np.zeros((1 + FEATURE_COUNT, BIN_COUNT, len(DOMAINS)))
    weights[0, 0] = np.log(prior / prior.sum())
    weights[1:] = np.log(counts / counts.sum(axis=1, keepdims=True))
    return weights


def with_posteriors(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """`rows` with columns p_0.. that sum to one."""
    for k in range(len(DOMAINS)):
        raw = F.lit(float(weights[0, 0, k]))
        for feature in range(FEATURE_COUNT):
            column = F.array(*[F.lit(float(x)) for x in weights[1 + feature, :, k]])
            raw = raw + F.element_at(column, F.element_at("bins", feature + 1) + 1)
        rows = rows.withColumn(f"raw_{k}", raw)
    top = F.greatest(*[F.col(f"raw_{k}") for k in range(len(DOMAINS))])
    total = reduce(lambda a, b: a + b, [F.exp(F.col(f"raw_{k}") - top) for k in range(len(DOMAINS))])
    rows = rows.withColumn("raw_top", top).withColumn("raw_total", total)
    for k in range(len(DOMAINS)):
        rows = rows.withColumn(f"p_{k}", F.exp(F.col(f"raw_{k}") - F.col("raw_top")) / F.col("raw_total"))
    return rows.drop("bins", "raw_top", "raw_total", *[f"raw_{k}" for k in range(len(DOMAINS))])


def _ahead(state: Column, step: Column) -> Column:
    change = reduce(lambda a, b: a + b, [F.col(f"p_{k}") * step[k] for k in range(len(DOMAINS))])
    rate = F.greatest(F.lit(0.0), state["ahead"] - change)
    ahead = rate + step[len(DOMAINS)] * (rate - state["rate"])
    return F.struct(rate.alias("rate"), ahead.alias("ahead"))


def after(steps: list[list[float]], which: str = "rate") -> Column:
    """The rate after the given steps, or the point ahead of it where the next slope is taken.

    A step subtracts posterior . slope, projects onto r >= 0 and looks ahead by its last number.
    """
    if not steps:
        return F.lit(1.0)
    listed = F.from_json(F.lit(json.dumps(steps)), "array<array<double>>")
    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
    return F.aggregate(listed, start, _ahead, lambda s: s[which])


def fit_rates(members: DataFrame, weights: list[float], ws: Workspace) -> list[list[float]]:
    """The steps whose `after` is the rate of a row, from its posterior alone.

    The budget keeps the first domain's expected total: its share of the targets equals what it
    has. Rows of one posterior have one rate, so totals are kept per distinct posterior, at most
    BIN_COUNT ** FEATURE_COUNT of them. Slopes are taken in the metric of tokens, in which the
    curvature is the largest eigenvalue of sum(tokens * p p'), a small matrix. A domain without any
    mass gets no target.
    """
    size = range(len(DOMAINS))
    names = [f"p_{k}" for k in size]
    profiles = ws.land(members.groupBy(*names).agg(F.sum("tokens").alias("tokens")).coalesce(4), "profiles")

    def totals(rate: Column) -> np.ndarray:
        row = (
            profiles.withColumn("mass", rate * F.col("tokens"))
            .agg(*[F.sum(F.col("mass") * F.col(n)) for n in names])
            .first()
        )
        return np.array([x or 0.0 for x in row])

    have = totals(F.lit(1.0))
    row = profiles.agg(*[F.sum(F.col("tokens") * F.col(a) * F.col(b)) for a in names for b in names]).first()
    curve = np.array([x or 0.0 for x in row]).reshape(len(names), -1)
    share = np.array(weights, float) / sum(weights)
    if not have.sum():
        return []
    budget = have[0] / share[0] if share[0] > 0 and have[0] > 0 else have.sum()
    targets = np.where(have > 0, share * budget, 0.0)
    speed = 1.0 / max(np.linalg.eigvalsh(curve)[-1], 1e-9)
    steps: list[list[float]] = []
    momentum, ahead = 1.0, have
    for _ in range(STEPS):
        gap = ahead - targets
        if np.abs(gap).max() <= TOLERANCE * budget:
            break
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        steps.append([*(speed * gap).tolist(), (momentum - 1) / following])
        momentum = following
        ahead = totals(after(steps, "ahead"))
    return steps


def prepared(docs: DataFrame, labels: DataFrame, ws: Workspace) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """doc_id, text_key, tokens and the posterior of every row, landed; and what adds the last two.

    Learns from the `LABELLED` labelled documents of the smallest hashed ids.
    """
    domain = domain_of(F.col("quality").cast("int"), F.col("toxic").cast("int"))
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain"))
        .where("doc_id IS NOT NULL AND domain IS NOT NULL")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "domain")
        .limit(LABELLED)
    )
    labelled = ws.land(id_text(docs).join(F.broadcast(known), "doc_id").select("text", "domain"), "labelled")
    lexicon = learn_lexicon(labelled)
    weights = learn_posterior(features(labelled, lexicon))

    def judged(rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn("text_key", F.xxhash64("text"))
        return with_posteriors(features(keyed, lexicon).drop("text"), weights)

    members = ws.land(judged(id_text(docs)), "members")
    ws.drop("labelled")
    return members, judged


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float]) -> DataFrame:
    """doc_id, tokens, domain, posterior_<domain> and rate of every row.

    `weights` gives each domain's share of the tokens. Null and empty texts have no tokens, keep a
    posterior and a rate, and move no total. Equal rows get equal rates. Without labelled
    documents the posterior is uniform.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    members, _ = prepared(docs, labels, ws)
    steps = fit_rates(members, [weights[d] for d in DOMAINS], ws)
    size = range(len(DOMAINS))
    top = F.greatest(*[F.col(f"p_{k}") for k in size])
    domain = reduce(
        lambda rest, k: F.when(F.col(f"p_{k}") == top, DOMAINS[k]).otherwise(rest),
        reversed(size),
        F.lit(None).cast("string"),
    )
    return members.select(
        "doc_id", "tokens", domain.alias("domain"),
        *[F.col(f"p_{k}").alias(f"posterior_{d}") for k, d in enumerate(DOMAINS)],
        after(steps).alias("rate"),
    )


def draw(docs: DataFrame, labels: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The rows of `docs`, each as often as its rate asks: the whole part of the rate plus a copy
    whose chance is the fraction, by a hash of id and text. All columns stay as they are.

    A rate follows from the row's own posterior, so the second pass judges each text again rather
    than join the texts with their rates; no text is shuffled.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    members, judged = prepared(docs, labels, ws)
    steps = fit_rates(members, [weights[d] for d in DOMAINS], ws)
    chance = F.pmod(F.xxhash64("doc_id", "text_key", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(after(steps) + chance).cast("int")
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = docs.select(
        whole,
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return judged(rows).select("row", F.explode(F.array_repeat(F.lit(1), copies))).select("row.*")
