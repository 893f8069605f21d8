"""Vector operators, shards and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from meterloom.llm import adsampling, hilbert, mixing, queries, rabitq
from meterloom.llm.components import components
from meterloom.llm.shared import staged_path
from meterloom.llm.vectors import rotation

VECTORS = "vec_id bigint, embedding array<float>, label int, id string, v string"


def vector_rows(n=400, dimension=24, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    centre = rng.standard_normal(dimension)
    for i in range(n):
        if i % 5 == 0:
            v = centre + rng.standard_normal(dimension) * rng.choice([0.05, 0.3, 0.6])
        else:
            v = rng.standard_normal(dimension)
        rows.append((i * 2, v.astype(np.float32).tolist(), None, "x", None))
    rows += [(5001, rows[0][1], 1, None, None), (5003, rows[0][1], 1, None, None)]
    rows += [(5005, [2 * x for x in rows[0][1]], 1, None, None)]
    odd = [None, [], [0.0] * dimension, [math.nan] * dimension, [math.inf] + [1.0] * (dimension - 1)]
    odd += [[None] + [1.0] * (dimension - 1), [1.0, 2.0]]
    return rows + [(6000 + i, v, None, None, None) for i, v in enumerate(odd)]


def cosines(rows, dimension=24):
    good = [(i, v) for i, v, *_ in rows if v and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids = np.array([i for i, _ in good])
    table = np.array([v for _, v in good], np.float32).astype(np.float64)
    return ids, table


def test_near_vectors_equal_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    ids, table = cosines(rows)
    unit = table / np.sqrt((table * table).sum(axis=1))[:, None]
    near = unit @ unit.T >= 0.9
    links = {r[0]: [] for r in rows}
    for a, b in zip(*np.nonzero(near)):
        if a != b:
            links[int(ids[a])].append(int(ids[b]))
    lowest = brute.reachable(links)
    want = {i: (len(links[i]), lowest[i], lowest[i] == i) for i in links}
    got = {
        r.vec_id: (r.n_links, r.component_id, r.kept)
        for r in rabitq.near_vectors(df, "vec_id", "embedding").collect()
    }
    assert got == want
    assert rabitq.near_vectors(df.limit(0), "vec_id", "embedding").count() == 0


def test_a_large_bucket_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "CHUNK", 16)
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(24)
    rows = [(i, (centre + rng.standard_normal(24) * 0.02).astype(np.float32).tolist(), None, None, None) for i in range(120)]
    got = rabitq.near_vectors(spark.createDataFrame(rows, VECTORS), "vec_id", "embedding").collect()
    assert {(r.n_links, r.component_id) for r in got} == {(119, 0)}


def test_codes_bound_the_cosine():
    rng = np.random.default_rng(2)
    unit = rabitq.units(rng.standard_normal((2000, 64)))
    unit[1000:] = rabitq.units(unit[:1000] + 0.3 * rng.standard_normal((1000, 64)) / 8)
    code, factor = rabitq.codes(unit)
    most = rabitq.upper_bounds(code[:1000], factor[:1000], code[1000:], factor[1000:], 64)
    exact = (unit[:1000] * unit[1000:]).sum(axis=1)
    assert (most >= exact).mean() > 0.999
    apart = rabitq.upper_bounds(code[:999], factor[:999], code[1:1000], factor[1:1000], 64)
    assert (apart < 0.9).mean() > 0.6


def test_search_finds_the_nearest(spark):
    rows = vector_rows(1500)
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    ids, table = cosines(rows)
    found = adsampling.search(df, df.filter("vec_id % 20 = 0"), "vec_id", "embedding", 10).collect()
    by_query: dict[int, list] = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for i, at in enumerate(ids):
        if at % 20:
            continue
        score = table @ table[i]
        score[i] = -np.inf
        want = ids[np.lexsort((ids, -score))[:10]].tolist()
        got = by_query[int(at)]
        assert [r["rank"] for r in got] == list(range(1, 11))
        assert all(abs(r.score - table[ids.tolist().index(r.vec_id)] @ table[i]) < 1e-9 for r in got)
        hits += len(set(want) & {r.vec_id for r in got})
        total += 10
    assert hits / total >= 0.9
    assert adsampling.search(df.limit(0), df, "vec_id", "embedding", 10).count() == 0


def test_few_candidates_are_all_found(spark):
    rows = [(i, [1.0, float(i % 2)], None, None, None) for i in range(6)]
    df = spark.createDataFrame(rows, VECTORS)
    found = adsampling.search(df, df.filter("vec_id = 0"), "vec_id", "embedding", 20).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [1, 2, 3, 4, 5]


def test_rotation_keeps_lengths():
    turn = rotation(33, 1)
    assert np.allclose(turn @ turn.T, np.eye(33))


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(80)]
    links += [(None, 3), (5, 5), (7, 6)]
    both: dict[int, list[int]] = {}
    for a, b in links:
        if a is not None and a != b:
            both.setdefault(a, []).append(b)
            both.setdefault(b, []).append(a)
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in found} == brute.reachable(both)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rounds_of_components_leave_no_more_partitions_than_links_need(spark, monkeypatch):
    from meterloom.llm import components as module

    left = []

    def counted(df):
        out = checkpointed(df)
        left.append(out.rdd.getNumPartitions())
        return out

    checkpointed = module.checkpointed
    monkeypatch.setattr(module, "checkpointed", counted)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    links = [(i, i + 1) for i in range(30) if i % 10] + [(50, 60), (60, 50), (7, 7), (None, 3)]
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = module.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    wanted = {i: i - (i - 1) % 10 for i in range(1, 31)} | {50: 50, 60: 50}
    assert sorted(map(tuple, found)) == sorted(wanted.items())
    assert len(left) > 2 and max(left[2:]) <= module.LEAST_TASKS



@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 2)])
def test_the_curve_visits_neighbours(spark, dimensions, bits):
    n = 1 << bits
    cells = spark.range(n**dimensions).select(
        *[(F.col("id") / n**d).cast("bigint").alias(f"c{d}") for d in range(dimensions)]
    ).select(*[(F.col(f"c{d}") % n).alias(f"c{d}") for d in range(dimensions)])
    rows = cells.withColumn(
        "at", hilbert.curve_index([F.col(f"c{d}") for d in range(dimensions)], bits)
    ).orderBy("at").collect()
    assert [r.at for r in rows] == list(range(n**dimensions))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[d] - b[d]) for d in range(dimensions)) == 1


def test_shards_are_even_and_without_gaps(spark):
    rows = [(i if i % 50 else None, None if i % 7 == 0 else "s" * (i % 4), 10 if i < 400 else i, 1) for i in range(1003)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, shard int").repartition(5)
    axes = [F.col("size"), hilbert.text_axis("source")]
    placed = hilbert.assign_shards(df, axes, 24, "doc_id")
    found = placed.collect()
    by: dict[int, list[int]] = {}
    for r in found:
        by.setdefault(r.shard, []).append(r.slot)
    assert len(found) == 1003 and sorted(by) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert {len(s) for s in by.values()} == {41, 42}
    few = hilbert.assign_shards(df.limit(5), axes, 24, "doc_id").collect()
    assert sorted((r.shard, r.slot) for r in few) == [(i, 0) for i in range(5)]
    assert hilbert.assign_shards(df.limit(0), axes, 24, "doc_id").count() == 0
    path = staged_path(spark, "shards")
    hilbert.write_shards(placed, path)
    assert spark.read.parquet(path).count() == 1003


def test_op9_gives_every_row_its_shard_and_slot(spark, tmp_path):
    """Against a plain version: rows by curve, part and id, cut into runs; ties, copies, odd rows."""
    import zlib

    import xxhash

    rng = random.Random(3)
    rows = [(i * 3 - 200, " ".join(rng.choices(["a", "bé", "東"], k=rng.randint(0, 300))), f"src{rng.randrange(20)}", rng.choice(["en", "de", None])) for i in range(700)]
    rows += [(5000 + i, "copy", "src1", "en") for i in range(400)] + [(9000, None, None, None), (9001, "", "", "en"), (9002, "x" * 300_000, "src3", "en")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.QUERIES["op9_hilbert"](spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)

    def part(doc_id):
        h = xxhash.xxh64_intdigest(int(doc_id).to_bytes(8, "little", signed=True), 42)
        return (h - (1 << 64) if h >> 63 else h) % hilbert.SPREAD

    order = sorted(found, key=lambda i: (found[i].curve, part(i), i))
    each, more = divmod(len(order), queries.SHARDS)
    sizes = [each + (s < more) for s in range(queries.SHARDS)]
    wanted = [(s, k) for s, n in enumerate(sizes) for k in range(n)]
    assert [(found[i].shard, found[i].slot) for i in order] == wanted
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        r = found[doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)


# Names that the operators use themselves, and odd ones.
CLASHING = (
    "key", "id", "_id", "_source", "kept", "spans", "n_removed", "epoch", "block", "place", "score",
    "evidence", "component_id", "whole", "last", "other_0", "a.b", "n tokens",
)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A small corpus with toxic texts, near copies, shared passages and odd rows."""
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "né") for b in range(200)]
    passage = " ".join(rng.choices(words, k=40))
    rows = []
    for i in range(400):
        text = rng.choices(words, k=rng.randint(20, 120))
        if i % 10 == 3:
            text[5] = rng.choice(["vile", "nasty"])
        if i % 25 == 7:
            text.append(passage)
        rows.append((i, " ".join(text)))
    rows += [(400 + k, rows[k][1] + " more") for k in (1, 2, 4)] + [(500, None), (501, "")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = [(i, t, "en", f"s{i % 3}", len(t or ""), *[f"{c}{i}" for c in CLASHING]) for i, t in rows]
    clashing = "".join(f", `{c}` string" for c in CLASHING)
    spark.createDataFrame(
        docs, f"doc_id bigint, text string, lang string, source string, n_chars bigint{clashing}"
    ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(
        [(i, 1, int(i % 10 == 3)) for i in range(400)], "doc_id bigint, quality int, toxic int"
    ).write.parquet(f"{folder}/labels.parquet")
    return folder, {i: (t, f"s{i % 3}") for i, t in rows}


def test_pipeline_equals_its_plain_version(spark, corpus):
    folder, docs = corpus
    found = spark.read.parquet(f"{folder}/documents.parquet")
    columns = found.columns
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = corpus_pipeline.staged(stage(spark, found, folder), name)
        assert found.columns == columns
        for row in found.drop("text").collect():
            assert [row[c] for c in CLASHING] == [f"{c}{row.doc_id}" for c in CLASHING], name
        after[name] = found.select("doc_id", "text").collect()
    clean = {i: t for i, (t, _) in docs.items() if i >= 400 or i % 10 != 3}
    assert {r.doc_id for r in after["toxicity"]} == set(clean)
    kept = {i for i, f in brute.near_duplicates(clean).items() if f[2]}
    assert {r.doc_id for r in after["near_duplicates"]} == kept
    cut = brute.repeats_removed({i: clean[i] for i in kept})
    removed = {r.doc_id: len((clean[r.doc_id] or "").encode()) - len((r.text or "").encode()) for r in after["repeats"]}
    # A character that is only partly covered stays: at most three bytes at each end.
    assert all(0 <= cut[i][1] - n <= 6 * cut[i][2] for i, n in removed.items())
    assert sum(removed.values()) > 1000
    assert {r.doc_id for r in after["mixing"]} <= set(removed)
    tokens = corpus_pipeline.STAGES[-1][1](spark, found, folder).collect()
    library = Tokenizer.from_file(queries.TOKENIZER)
    texts = {r.doc_id: r.text or "" for r in after["mixing"]}
    assert len(tokens) == len(after["mixing"])
    for r in tokens:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids, r.ids_sha256) == (len(ids), raw, hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pipeline_of_nothing(spark, corpus, tmp_path):
    folder, _ = corpus
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_stages_on_odd_rows(spark, corpus):
    """Null ids and columns, repeated rows, equal texts: every stage gives what it states."""
    folder, _ = corpus
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(None, "some words of nobody in particular here", None, None, None, None), (1, None, None, "s", 0, "a"),
            (2, "", None, None, None, None), (3, long, "en", "s", 1, "b"), (3, long, "en", "s", 1, "b"),
            (4, long + " tail", None, "s", 2, None), (5, "kalo0 alone", None, "t", None, "c")]
    docs = spark.createDataFrame(rows, schema)
    found = {name: stage(spark, docs, folder).collect() for name, stage in corpus_pipeline.STAGES}
    ids = {name: sorted((r.doc_id for r in rows_), key=str) for name, rows_ in found.items()}
    assert ids["toxicity"] == [1, 2, 3, 3, 4, 5, None]
    assert ids["near_duplicates"] == [1, 2, 3, 3, 5, None]
    assert ids["repeats"] == [1, 2, 3, 3, 4, 5, None]
    cut = {r.doc_id: r for r in found["repeats"]}
    assert len(cut[4].text) < 20 and cut[4].n_chars == len(cut[4].text) and cut[3].text == long
    assert cut[1].text is None and cut[2].text == "" and cut[5].score == "c"
    assert ids["tokens"] == [1, 2, 3, 3, 4, 5, None]
    assert {r.n_tokens for r in found["tokens"] if r.doc_id in (1, 2)} == {0}
    assert {*ids["mixing"]} <= {1, 2, 3, 4, 5, None}


def test_mix_in_sql(spark):
    """The twin of the mix on sources of very different sizes."""
    duckdb = pytest.importorskip("duckdb")
    rows = [(i, "x" * (i % 40), "big" if i % 9 else f"s{i % 4}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    df = docs.select("doc_id", "source", mixing.estimated_tokens("text").alias("tokens"))
    mixed = mixing.mix(df, "doc_id", "source", F.col("tokens"), **queries.MIX)
    with duckdb.connect() as connection:
        frame = docs.toPandas()  # noqa: F841
        want = connection.sql(mixing.mix_sql("frame", **queries.MIX)).fetchall()
    assert sorted(map(tuple, mixed.collect())) == sorted(want)


def test_partial_distances_give_up_the_same_rows_for_many_queries_at_once():
    rng = np.random.default_rng(8)
    rows, queries = rng.normal(size=(300, 37)), rng.normal(size=(9, 37))
    bounds = np.array([np.inf, 20.0, 30.0, 40.0, 0.0, 50.0, 60.0, 45.0, np.inf])
    found = adsampling.survivors(rows, queries, bounds)
    assert found.shape == (9, 300) and found[0].all() and not found[4].any()
    for query, bound, alive in zip(queries, bounds, found):
        wanted = np.ones(300, bool)
        for seen in (16, 32, 37):
            slack = 1.0 if seen == 37 else (1 + adsampling.CONFIDENCE / seen**0.5) ** 2
            wanted &= ((rows - query)[:, :seen] ** 2).sum(axis=1) * 37 / seen <= bound * slack
        assert (alive == wanted).all()
