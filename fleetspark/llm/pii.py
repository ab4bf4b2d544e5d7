"""Personal data by bootstrapped contextual extraction, on DataFrame functions alone.

Four checked patterns give seed entities. The one to three words before and after an entity, and the
two words around it, are its lexical patterns; other identifier-like tokens in the same patterns are
unseen instances. Patterns and instances form a bipartite graph that is scored in rounds: a pattern is
as good as the share of seeds and accepted instances among its distinct instances, an unseen instance
as good as the best supported patterns on its sides together (noisy or). What a round accepts supports
patterns of the next, so patterns without any seed are induced as well; a pattern's own vote for what
is not accepted never raises its share. Unseen instances of high-confidence patterns become further
spans; the seeds' own spans never change.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import Workspace, id_text

KINDS = ("email", "ip", "card", "phone")
# Possessive forms of the fixed patterns. The look-behinds skip starts inside a run that has just
# failed as a whole; \G readmits the place where the last match ended.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# A run of two or more digit groups joined by single spaces, or one token.
GROUP = r"[(\[]*+[0-9][0-9().\[\]/-]*+"
TOKEN = (
    rf"(?<![^\x20\x09-\x0D])(?:\+?{GROUP}(?:\x20{GROUP}(?![^\x20\x09-\x0D,;:!?]))++[,;:!?)\]]*+(?![^\x20\x09-\x0D])"
    r"|[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)"
)

CONTEXT_CHARS = 80
CONTEXT_WORDS = 3
LEAST_SUPPORT = 5  # distinct seeds and accepted instances of a pattern that may vote
CONFIDENCE = 0.8
ROUNDS = 3
SCAN_BLOCK = 512
AROUND = "array<struct<side:int,pattern:bigint>>"
SPANS = f"array<struct<start:int,rank:int,end:int,value:string,around:{AROUND}>>"


def _bound(value: Column, body) -> Column:
    """`body` of a value that is computed once, also where lambda functions use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan_array(values: Column, zero: Column, combine) -> Column:
    """Running values of an associative function, by blocks: whole arrays are not copied at each step."""
    none = F.array().cast("array<int>")

    def added(done: Column, value: Column) -> Column:
        last = F.coalesce(F.get(done, F.size(done) - 1), zero)
        return F.concat(done, F.array(combine(last, value)))

    def by_blocks(whole: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / SCAN_BLOCK).cast("int"))
        return F.transform(
            numbers, lambda n: F.aggregate(F.slice(whole, n * SCAN_BLOCK + 1, SCAN_BLOCK), none, added)
        )

    def joined(blocks: Column) -> Column:
        carried = F.aggregate(blocks, F.array(zero), lambda done, block: added(done, F.get(block, F.size(block) - 1)))
        return F.flatten(
            F.zip_with(
                blocks, F.slice(carried, 1, F.size(blocks)), lambda block, c: F.transform(block, lambda v: combine(c, v))
            )
        )

    return _bound(values, lambda whole: F.when(F.size(whole) > 0, _bound(by_blocks(whole), joined)).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _small_parts(value: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(value, r"\."), small)


def _luhn(value: Column) -> Column:
    digits = _digits(value)

    def weighed(digit: Column, place: Column) -> Column:
        number = F.coalesce(digit.try_cast("int"), F.lit(0))
        doubled = number * 2 - F.when(number >= 5, 9).otherwise(0)
        return F.when(place % 2 == 1, doubled).otherwise(number)

    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), weighed), F.lit(0), lambda a, b: a + b
    )
    return F.length(digits).between(14, 19) & (total % 10 == 0)


def _phone_digits(value: Column) -> Column:
    return F.length(_digits(value)).between(10, 15)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.translate(text, "\t\n\x0b\x0c\r", "     ")), " "), lambda w: w != "")


def _around(before: Column, after: Column) -> Column:
    """array<struct<side, pattern>>: the hashed patterns of an entity between two stretches of text."""

    def patterns(words: Column) -> Column:
        left, right = words["left"], words["right"]
        own = [
            F.when(F.size(side) >= n, F.struct(F.lit(number), F.xxhash64(F.lit(number), F.slice(side, first, n))))
            for n in range(1, CONTEXT_WORDS + 1)
            for number, side, first in ((0, left, -n), (1, right, 1))
        ]
        both = F.when(
            (F.size(left) > 0) & (F.size(right) > 0),
            F.struct(F.lit(2), F.xxhash64(F.lit(2), F.slice(left, -1, 1), F.slice(right, 1, 1))),
        )
        return F.filter(F.array(*own, both), lambda p: p.isNotNull()).cast(AROUND)

    right = _words(F.regexp_replace(after, r"^[.,;:!?)\]]+", ""))
    return _bound(F.struct(_words(before).alias("left"), right.alias("right")), patterns)


def _matches(text: Column, pattern: str, context: bool = True) -> Column:
    """array<struct<value, end, around>> of the leftmost non-overlapping matches.

    The pieces between matches give the positions, in code points, and the words around a match; the
    match before and the one after count as such words. Without `context`, `around` is null.
    """
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"), F.split(text, pattern, -1).alias("gaps")
    )

    def piece(of: Column, at: Column) -> Column:
        return F.coalesce(F.get(of, at), F.lit(""))

    def entities(both: Column) -> Column:
        values, gaps = both["values"], both["gaps"]
        lengths = F.zip_with(values, F.slice(gaps, 1, F.size(values)), lambda v, g: F.length(g) + F.length(v))

        def around(n: Column) -> Column:
            before = F.concat(F.right(piece(gaps, n - 1), F.lit(CONTEXT_CHARS)), piece(values, n - 1), piece(gaps, n))
            after = F.concat(F.left(piece(gaps, n + 1), F.lit(CONTEXT_CHARS)), piece(values, n + 1))
            return _around(F.right(before, F.lit(CONTEXT_CHARS)), F.left(after, F.lit(CONTEXT_CHARS)))

        patterns = F.transform(values, lambda _, n: around(n) if context else F.lit(None).cast(AROUND))
        return F.arrays_zip(
            values.alias("value"), _scan_array(lengths, F.lit(0), lambda x, y: x + y).alias("end"), patterns.alias("around")
        ).cast(f"array<struct<value:string,end:int,around:{AROUND}>>")

    return _bound(found, entities)


def _spans(found: Column, rank: int) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(
            (s["end"] - F.length(s["value"])).alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
            s["value"].alias("value"), s["around"].alias("around"),
        ),
    ).cast(SPANS)


def _of_kind(text: Column, context: bool, kind: str, pattern: str, sign: Column, check) -> Column:
    found = _matches(text, pattern, context)
    if check is not None:
        found = F.filter(found, lambda s: check(s["value"]))
    return F.when(sign, _spans(found, KINDS.index(kind))).otherwise(F.array().cast(SPANS))


def seed_spans(text: Column, context: bool = True) -> Column:
    """The checked matches of all kinds, by start and then kind."""
    digit = F.rlike(text, F.lit("[0-9]"))
    found = F.concat(
        _of_kind(text, context, "email", EMAIL, F.contains(text, F.lit("@")), None),
        _of_kind(text, context, "ip", IP, digit, _small_parts),
        _of_kind(text, context, "card", CARD, digit, _luhn),
        _of_kind(text, context, "phone", PHONE, F.contains(text, F.lit("+")), _phone_digits),
    )
    return F.array_sort(found)


def _with_unseen(rows: DataFrame) -> DataFrame:
    """Adds `unseen`: identifier-like tokens and runs of digit groups that touch no seed, with an '@' or
    four digits, closing marks cut. A run that meets a seed ends before it.

    Seeds and tokens are merged by position; running ends and starts tell which of them meet.
    """
    text, beyond = F.col("text"), F.lit(2**31 - 1)
    tokens = F.when(F.rlike(text, F.lit("[0-9@]")), _spans(_matches(text, TOKEN), len(KINDS)))
    every = F.array_sort(F.concat("seeds", F.coalesce(tokens, F.array().cast(SPANS))))
    known = len(KINDS)

    def free_tokens(spans: Column) -> Column:
        ends = F.transform(spans, lambda s: F.when(s["rank"] < known, s["end"]).otherwise(0))
        starts = F.transform(F.reverse(spans), lambda s: F.when(s["rank"] < known, s["start"]).otherwise(beyond))
        near = F.zip_with(
            _scan_array(ends, F.lit(0), F.greatest),
            F.reverse(_scan_array(starts, beyond, F.least)),
            lambda ended, following: F.struct(ended.alias("ended"), following.alias("following")),
        )
        return F.filter(F.zip_with(spans, near, token), lambda s: s.isNotNull()).cast(SPANS)

    def token(span: Column, near: Column) -> Column:
        following = near["following"]
        run = F.contains(span["value"], F.lit(" ")) & (following > span["start"]) & (following < span["end"])
        cut = F.when(run, F.left(span["value"], following - span["start"])).otherwise(span["value"])
        value = F.regexp_replace(cut, r"[.,;:!?)\]\x20(\[]+$", "")
        free = (near["ended"] <= span["start"]) & (following >= span["start"] + F.length(value))
        fit = F.contains(value, F.lit("@")) | (F.length(_digits(value)) >= 4)
        return F.when(
            (span["rank"] == known) & free & fit,
            F.struct(
                span["start"].alias("start"), span["rank"].alias("rank"),
                (span["start"] + F.length(value)).alias("end"), value.alias("value"), span["around"].alias("around"),
            ),
        )

    return rows.withColumn("unseen", _bound(every, free_tokens))


def _instances(scanned: DataFrame) -> DataFrame:
    """One row for each entity and pattern around it."""
    spans = scanned.select("doc_id", "text_key", F.explode(F.concat("seeds", "unseen")).alias("s"))
    return spans.select(
        "doc_id", "text_key", "s.start", "s.rank", "s.end", "s.value", F.explode("s.around").alias("p")
    ).select("doc_id", "text_key", "start", "rank", "end", "value", "p.side", "p.pattern")


def _fits(mail: Column, kind: int) -> Column:
    """Only e-mail addresses hold an '@'."""
    return mail if KINDS[kind] == "email" else ~mail


def score_graph(edges: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Patterns (pattern, support_k, score_k) and unseen instances (value, score_k), k over the kinds.

    `edges` holds distinct (side, pattern, value, mail, rank); rank is a seed's kind or the number of
    kinds.
    """
    ranks = range(len(KINDS))
    own = [F.when(F.col("rank") == k, 1.0).otherwise(0.0).alias(f"held_{k}") for k in ranks]
    seeds = edges.where(F.col("rank") < len(KINDS)).select("pattern", *own)
    unseen = edges.where(F.col("rank") == len(KINDS)).drop("rank")
    values = None
    for turn in range(ROUNDS):
        if values is None:
            guesses = unseen.select("pattern", *[F.lit(0.0).alias(f"held_{k}") for k in ranks])
        else:
            accepted = [F.when(F.col(f"score_{k}") >= CONFIDENCE, 1.0).otherwise(0.0).alias(f"held_{k}") for k in ranks]
            guesses = unseen.join(values, "value").select("pattern", *accepted)
        patterns = ws.land(
            seeds.unionByName(guesses).groupBy("pattern").agg(
                *[F.sum(f"held_{k}").alias(f"support_{k}") for k in ranks],
                *[F.avg(f"held_{k}").alias(f"score_{k}") for k in ranks],
            ),
            f"patterns-{turn}",
        )
        # Only supported patterns vote.
        votes = [
            F.when(F.col(f"support_{k}") >= LEAST_SUPPORT, F.col(f"score_{k}")).otherwise(0.0).alias(f"vote_{k}")
            for k in ranks
        ]
        voted = unseen.join(patterns.select("pattern", *votes), "pattern")

        def best(k: int, side: int) -> Column:
            # Patterns of one side hold each other, so that the best of them speaks for all.
            there = _fits(F.col("mail"), k) & (F.col("side") == side)
            return F.max(F.when(there, F.col(f"vote_{k}")).otherwise(0.0))

        scores = [F.greatest(1 - (1 - best(k, 0)) * (1 - best(k, 1)), best(k, 2)).alias(f"score_{k}") for k in ranks]
        values = ws.land(voted.groupBy("value").agg(*scores), f"values-{turn}")
        if turn:
            ws.drop(f"patterns-{turn - 1}", f"values-{turn - 1}")
    return patterns, values


def contextual_spans(scanned: DataFrame, ws: Workspace) -> DataFrame:
    """doc_id, text_key, extra: the spans that high-confidence patterns add, once per text."""
    instances = _instances(scanned)
    mail = F.contains(F.col("value"), F.lit("@"))
    every = ws.land(
        instances.select("side", "pattern", F.xxhash64("value").alias("value"), mail.alias("mail"), "rank").distinct(),
        "every-edge",
    )
    # Fewer distinct instances than the least support can never vote.
    known_often = every.groupBy("pattern").agg(F.count_distinct("value").alias("n")).where(F.col("n") >= LEAST_SUPPORT)
    edges = ws.land(every.join(known_often, "pattern", "left_semi"), "edges")
    patterns, values = score_graph(edges, ws)
    ranks = range(len(KINDS))
    sure = F.greatest(
        *[
            F.when(
                (F.col(f"p.support_{k}") >= LEAST_SUPPORT) & (F.col(f"p.score_{k}") >= CONFIDENCE)
                & (F.col(f"v.score_{k}") >= CONFIDENCE) & _fits(mail, k),
                F.struct(F.col(f"p.score_{k}").alias("score"), F.lit(-k).alias("kind")),
            )
            for k in ranks
        ]
    )
    confident = reduce(or_, [F.col(f"score_{k}") >= CONFIDENCE for k in ranks])
    occurrences = (
        instances.where(F.col("rank") == len(KINDS))
        .join(patterns.where(confident).alias("p"), "pattern")
        .withColumn("value_key", F.xxhash64("value"))
        .join(values.where(confident).withColumnRenamed("value", "value_key").alias("v"), "value_key")
        .withColumn("best", sure)
        .where("best IS NOT NULL")
        .groupBy("doc_id", "text_key", "start", "end", "value")
        .agg(F.max("best").alias("best"))
    )
    span = F.struct(
        "start", (-F.col("best.kind")).alias("rank"), "end", "value", F.array().alias("around")
    )
    return (
        occurrences.groupBy("doc_id", "text_key")
        .agg(F.collect_set(span).alias("extra"))
        .withColumn("extra", F.col("extra").cast(SPANS))
    )


def _scan(rows: DataFrame) -> DataFrame:
    return _with_unseen(
        rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text", seed_spans(F.col("text")).alias("seeds"))
    ).drop("text")


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _count(spans: Column, rank: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans for every row.

    Counts and the digest cover the checked patterns only, `spans` all spans. A null or empty text
    has none; repeated rows repeat their result; equal instances count once in the graph.
    """
    ws = Workspace(docs.sparkSession, "pii")
    scanned = ws.land(_scan(id_text(docs)), "scanned")
    extra = ws.land(contextual_spans(scanned, ws), "extra")
    joined = scanned.alias("b").join(
        extra.alias("e"),
        F.col("b.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("b.text_key") == F.col("e.text_key")),
        "left",
    )
    spans = F.array_sort(F.concat("b.seeds", F.coalesce("e.extra", F.array().cast(SPANS))))
    counts = [_count(F.col("b.seeds"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return joined.select(
        "b.doc_id", *counts, F.sha2(_written(F.col("b.seeds")), 256).alias("base_sha256"),
        _written(spans).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the
    first stands and covers the others."""
    names = F.array(*[F.lit(f"<{kind.upper()}>") for kind in KINDS])

    def piece(span: Column, at: Column) -> Column:
        kept = F.concat(F.substring(text, at + 1, span["start"] - at), F.element_at(names, span["rank"] + 1))
        return F.when(span["start"] < at, "").otherwise(kept)

    def joined(found: Column) -> Column:
        ends = _scan_array(F.transform(found, lambda s: s["end"]), F.lit(0), F.greatest)

        def pieces(reached: Column) -> Column:
            before = F.slice(F.concat(F.array(F.lit(0)), reached), 1, F.size(found))
            rest = F.substring(text, F.get(reached, F.size(reached) - 1) + 1, F.length(text))
            return F.concat(F.array_join(F.zip_with(found, before, piece), ""), rest)

        return _bound(ends, pieces)

    return F.when(F.size(spans) > 0, _bound(spans, joined)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with personal data in `text` replaced, `n_chars` brought up to date.

    A null text stays null. Other columns, whatever their names, stay as they are.
    """
    ws = Workspace(docs.sparkSession, "pii")
    scanned = ws.land(_scan(id_text(docs)), "scanned")
    extra = ws.land(contextual_spans(scanned, ws), "extra").select(
        F.struct("doc_id", "text_key", "extra").alias("__pii_extra")
    )
    text = F.col("text").cast("string")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    spans = F.array_sort(
        F.concat(seed_spans(F.coalesce(text, F.lit("")), context=False), F.coalesce("__pii_extra.extra", F.array().cast(SPANS)))
    )
    clean = redacted(text, spans)
    found = docs.join(
        extra,
        F.col("doc_id").cast("long").eqNullSafe(F.col("__pii_extra.doc_id"))
        & (key == F.col("__pii_extra.text_key")),
        "left",
    ).withColumn("__pii_text", clean)
    columns = [
        F.col("__pii_text").alias("text")
        if name == "text"
        else F.when(F.col("text").isNull(), F.col("n_chars"))
        .otherwise(F.length("__pii_text"))
        .cast(docs.schema[name].dataType)
        .alias("n_chars")
        if name == "n_chars"
        else F.col(f"`{name}`")
        for name in docs.columns
    ]
    return found.select(*columns)
