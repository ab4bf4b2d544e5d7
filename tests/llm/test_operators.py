"""The corpus operators on small fixtures: brute force, round trips, SQL and odd rows."""

from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from fleetspark.llm import ann, kdtree, licenses, lm, mixing, near_dedup, packing, pii, quality, queries, sharding
from fleetspark.llm.common import table, words_of
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score double, kept string"
ODD = [
    (None, "no id at all", 1.0, "x"),
    (7, None, None, None),
    (8, "", 1.0, ""),
    (9, "one", 1.0, "y"),
    (9, "one", 1.0, "y"),
    (10, "word " * 30_000, 2.0, "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF).execute(queries.ORACLE[name])) is None


def test_odd_rows_keep_their_number(odd, labels):
    path = queries.tokenizer_path()
    assert near_dedup.near_duplicates(odd).count() == len(ODD)
    assert sharding.assign_shards(odd, 1000).count() == len(ODD)
    assert pii.find_pii(odd).count() == len(ODD)
    assert lm.score_texts(odd).count() == len(ODD)
    assert quality.quality(odd, labels).count() == len(ODD)
    assert licenses.scan_licenses(odd).count() == len(ODD)
    assert mixing.mix(odd, labels, queries.MIX_WEIGHTS).count() == len(ODD)
    assert packing.pack(odd, path).agg({"length": "sum"}).first()[0] > 30_000


def test_empty_tables(none, labels):
    for found in (
        near_dedup.near_duplicates(none),
        sharding.assign_shards(none, 1000),
        pii.find_pii(none),
        lm.score_texts(none),
        quality.quality(none, labels.limit(0)),
        licenses.scan_licenses(none),
        mixing.mix(none, labels.limit(0), queries.MIX_WEIGHTS),
        packing.pack(none, queries.tokenizer_path()),
    ):
        assert found.count() == 0


def test_shards_fit_their_limit(spark):
    rows = [(1, "abcde")] * 25 + [(2, "x" * 40), (3, None)]
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()
    sums: Counter = Counter()
    for row in found:
        sums[row["shard"], row["page"]] += row["bytes"]
    assert all(n <= 20 or n == 40 for n in sums.values())
    assert len(found) == len(rows)


def test_near_duplicates_without_the_centre(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[: 200 - 8 * i] + [f"n{i}x{j}" for j in range(8 * i)])) for i in range(8)]
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 85, 100).collect()}
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(196)} for i, t in rows}
    parent = dict.fromkeys(sets)
    for i in sets:
        parent[i] = i
    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = parent[i], parent[j]
                parent = {k: min(a, b) if v in (a, b) else v for k, v in parent.items()}
    assert found == parent


def test_context_finds_unseen_identifiers(spark):
    rows = [(i, f"Ring tel: +1 ({200 + i}) 555-{1000 + i} now") for i in range(20)]
    rows += [(100, "tel: 555-2000, the 770881")]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    row = found.where("doc_id = 100").first()
    assert (row["n_phone"], row["spans"]) == (0, "phone:5:13")


def test_redaction_keeps_columns(spark):
    rows = [(1, "mail a@b.co and é 1.2.3.4 x", "q", 3), (2, None, "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_chars long")
    found = {r["doc_id"]: tuple(r) for r in pii.redact(docs).collect()}
    assert found == {1: (1, "mail <EMAIL> and é <IP> x", "q", 25), 2: (2, None, "s", 9)}


def test_packing_ids_are_the_tokenizers():
    """Odd words, special tokens and white space get the ids that the whole tokenizer gives."""
    path = queries.tokenizer_path()
    texts = [
        "don't I'LL 'S it's's O'Neill's!!", "a<|endoftext|>b <|x|> <| <|startoftext|>",
        "\u03a3\u0391\u03a3 \u0130stanbul x\u0085y \x1cq\x1dr\u00a0\u2028z", "e\u0301clair \u00c9\u00b2\u00be \u00aa\u00ba \u00b5\u00df \u00ff\u0178",
        "\u65e5\u672c\u8a9e \U0001f600\U0001f600 12345 1,234.56", "", "  ", "\x00\x01 a\x7fb", "x" * 5000,
        "\u00bf\u00a1\u00ab\u00bb \u00b7\u00a7 \u00adsoft\u00adhyphen",
    ]
    got = packing.token_ids([t.encode() for t in texts], path)
    whole = packing._tokenizer(path)
    for text, ids in zip(texts, got):
        expected = whole.encode(text, add_special_tokens=False).ids + [packing.END]
        assert np.frombuffer(ids, np.uint16).tolist() == expected


def test_packing_words_in_use_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 2)
    path = queries.tokenizer_path()
    known = packing.WordIds(path)
    known.learn([b"alpha", b"Alpha", b"beta,", b"it's"])
    kept = dict(known)

    def unknown(text):
        raise AssertionError(text)

    monkeypatch.setattr(known, "piece", unknown)
    known.learn([b"alpha", b"beta,"])
    assert dict(known) == {word: kept[word] for word in (b"alpha", b"beta,")}
    texts = ["alpha Alpha beta, it's", " one  two\x0bthree\x0c", "four two, alpha\x1cbeta"]
    for _ in range(3):
        for text, ids in zip(texts, packing.token_ids([t.encode() for t in texts], path)):
            expected = packing._tokenizer(path).encode(text, add_special_tokens=False).ids + [packing.END]
            assert np.frombuffer(ids, np.uint16).tolist() == expected


def test_packing_cuts_many_words_at_once_and_keeps_none():
    path = queries.tokenizer_path()
    known, calls = packing.WordIds(path), []

    class Counting:
        def findall(self, text, cut=known.cut):
            calls.append(text)
            return cut.findall(text)

    known.cut = Counting()
    known.learn([f"w{i},x".encode() for i in range(1000)])
    assert len(calls) == 1 and len(known) == 1000
    texts = [" ".join(f"w{i}q{j}," for j in range(1000)).encode() for i in range(50)]
    packing.token_ids(texts[:1], path)
    tracemalloc.start()
    packing.token_ids(texts, path)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 1 << 20


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(queries.tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    ids = {i: np.array(coder.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    pieces = queries.op6_packing(spark, SF).toPandas()
    for p in pieces.itertuples():
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
    assert pieces["length"].sum() == sum(map(len, ids.values()))
    sizes = pieces.groupby("sequence_id")["length"].sum()
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sizes)


def test_base_score_by_brute_force(spark):
    texts = [(r["doc_id"], r["text"] or "") for r in table(spark, SF, "documents").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts}
    split = {i: [*words_of(t.encode()), b"\n"] for i, t in texts}
    counts = Counter(w for i, _ in texts if not held[i] for w in split[i])
    total, kinds = sum(counts.values()), len(counts)
    for row in queries.op5_lm_score(spark, SF).collect():
        tokens = split[row["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        assert row["base_score"] == pytest.approx(base)
        assert row["n_known"] == sum(counts[w] > 0 for w in tokens) and row["score"] < 0


def test_suffix_tree_sums_to_one():
    tree = lm.SuffixTree(np.arange(256.0))
    follow = np.zeros(256)
    follow[65] = 100
    tree.add(b"a", follow)
    log, child = tree.finish()
    assert np.allclose((10.0**log.astype(float)).sum(axis=1), 1, atol=1e-4) and child[0][97] == 1


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    scored = quality.quality(table(spark, sf, "documents"), table(spark, sf, "labels"))
    right = scored.join(table(spark, sf, "labels"), "doc_id").where("held_out").selectExpr(
        "avg(CAST(predicted = quality AS INT))"
    ).first()[0]
    assert right >= 0.97


def test_neighbours_reach_recall(spark):
    rows = table(spark, SF, "embeddings").toPandas()
    ids, points = rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), float)
    found = queries.op2_ann(spark, SF).toPandas()
    hits = total = 0
    for own in ids[ids % 100 == 0]:
        far = np.sqrt(((points - points[ids == own][0]) ** 2).sum(axis=1))
        far[ids == own] = np.inf
        hits += len(set(ids[np.lexsort((ids, far))[:10]]) & set(found[found.query_id == own].vec_id))
        total += 10
    assert hits / total >= 0.9


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [0.5, 0.0]), (5, [0.5, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = vectors.where("vec_id = 0")
    assert [(r["rank"], r["vec_id"]) for r in ann.nearest(vectors, asked).orderBy("rank").collect()] == [(1, 4), (2, 5)]
    assert [(r["vec_id"], r["score"]) for r in kdtree.top_k(vectors, asked).orderBy("rank").collect()] == [
        (4, 1024 * 512), (5, 1024 * 512), (1, 0)]
    assert ann.nearest(vectors.limit(0), asked.limit(0)).count() == 0
    assert kdtree.top_k(vectors.limit(0), asked.limit(0)).count() == 0


def test_tree_equals_brute_force():
    dealt = np.random.default_rng(3)
    points = dealt.integers(-50, 50, (2000, 4)).astype(float)
    tree = kdtree.Tree(points, np.arange(2000))
    for own in range(0, 2000, 200):
        scores = points @ points[own]
        scores[own] = -np.inf
        best = np.lexsort((np.arange(2000), -scores))[:10]
        assert {i for _, i in tree.search(points[own], own, 10, float("-inf"))} == set(best)


def test_licenses_and_coverage(spark):
    rows = [(1, "x y Released under the MIT License. z"), (2, "released under no license"), (3, None)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["license"], r["start"], r["end"]) for r in found] == [
        (1, "MIT", 2, 7), (2, None, None, None), (3, None, None, None)]


def test_rates_meet_targets(spark, labels):
    rates = mixing.mix(table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels"), queries.MIX_WEIGHTS)
    sums = rates.selectExpr(*[f"sum(rate * tokens * posterior_{d})" for d in mixing.DOMAINS], "min(rate)").first()
    assert sums[3] >= 0
    assert sums[1] / sums[0] == pytest.approx(0.04 / 0.95, rel=0.1)


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() > 0
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
