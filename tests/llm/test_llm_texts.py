"""Text operators against plain versions, and on the cases that break careless ones."""

from __future__ import annotations

import hashlib
import random
import re

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterloom.llm import arc, bpe, minmax, mixing, ordinal, queries, suffixes, toxicity
from meterloom.llm.shared import staged_path, text_bytes

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, id string"


def odd_rows():
    """Nulls, empty and long texts, copies, repeated rows, columns with clashing names."""
    rng = random.Random(5)
    names = ["alpha", "Beta", "gamma,", "déjà", "東京", "x1", "\x0bvt", "end."]
    long = " ".join(rng.choice(names) + str(rng.randrange(50)) for _ in range(30_000))
    passage = " ".join(rng.choice(names) + str(rng.randrange(500)) for _ in range(40))
    texts = [None, "", "   ", "one", "One", "a b c d e", long, long, passage, "x " + passage + " é"]
    texts += [passage + " " + t for t in ("tail", "tail", "other tail of it")]
    texts += ["aaaa" * 100, "a" * 99, "a" * 100, "a" * 101, "東" * 120, "<|endoftext|>x", "퟿"]
    rows = [(i, t, None, "s" if i % 3 else None, None, "k", "i") for i, t in enumerate(texts)]
    return rows + [rows[8], (None, passage, "en", "s", 1, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3)


def test_repeats_equal_brute_force(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    passages = [" ".join(rng.choices(words, k=rng.randint(20, 90))) for _ in range(12)]
    docs = {}
    for i in range(300):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 60)))]
        parts += rng.choices(passages, k=rng.choice((0, 0, 1, 2)))
        rng.shuffle(parts)
        docs[i * 7 - 50] = " ".join(parts)
    docs |= {9001: None, 9002: "", 9003: "ab" * 400, 9004: "ab" * 90, 9005: docs[-50], 9006: "a" * 3000}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(5)
    cut = suffixes.without_repeats(df, "doc_id").collect()
    got = {
        r.doc_id: (
            len((r.text or "").encode()), r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()
        )
        for r in cut
    }
    assert got == brute.repeats_removed(docs)


def test_a_common_beginning_with_many_ends(spark):
    """More continuations than are sent on singly: the marks have to do."""
    rng = random.Random(2)
    start = "".join(rng.choice("abcdefgh") for _ in range(80))
    docs = {
        i: "".join(rng.choice("xyz") for _ in range(60)) + start + "".join(rng.choice("mno") for _ in range(i % 9 + 18))
        for i in range(400)
    }
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.n_removed for r in suffixes.without_repeats(df, "doc_id").collect()}
    assert got == {k: v[1] for k, v in brute.repeats_removed(docs).items()}


def test_odd_rows_lose_repeats_once(odd):
    rows = suffixes.without_repeats(odd, "doc_id", whole_characters=True).collect()
    assert len(rows) == len(odd_rows())
    assert all(r.kept.decode() is not None for r in rows)
    assert next(r for r in rows if r.doc_id is None).n_removed == 0
    twice = [r for r in rows if r.doc_id == 8]
    assert len(twice) == 2 and all(r.n_removed == 0 for r in twice)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    docs = {}
    for g in range(40):
        base = rng.choices(words, k=rng.randint(4, 120))
        for _ in range(rng.choice((1, 2, 6))):
            copy = [rng.choice(words) if rng.random() < rng.choice((0, 0.01, 0.05)) else w for w in base]
            docs[len(docs) * 3] = " ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy)
    docs |= {-5: None, -4: "", -3: " \t ", -2: "one two", -1: "one two"}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {
        r.doc_id: (r.n_shingles, r.component_id, r.kept)
        for r in minmax.near_duplicates(df, "doc_id").collect()
    }
    assert got == brute.near_duplicates(docs)


def test_outsiders_of_a_large_group(spark):
    """Documents near the threshold of a group are compared with all of it."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    docs = {}
    for i in range(260):
        copy, edits = list(base), rng.randint(0, 12)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        docs[i] = " ".join(copy)
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in minmax.near_duplicates(df, "doc_id").collect()}
    assert got == {k: v[1] for k, v in brute.near_duplicates(docs).items()}


def test_near_duplicates_of_odd_rows(odd, spark):
    rows = minmax.near_duplicates(odd, "doc_id").collect()
    assert len(rows) == len(odd_rows())
    assert {r.n_shingles for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert minmax.near_duplicates(odd.limit(0), "doc_id").count() == 0


def test_bpe_equals_the_library(odd):
    library = Tokenizer.from_file(TOKENIZER)
    both = bpe.decode(bpe.encode(odd.withColumn("ids", F.lit(1)), TOKENIZER), TOKENIZER).collect()
    assert len(both) == len(odd_rows())
    for r in both:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_long_words_and_short_ones_agree():
    with open(TOKENIZER, encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    rng = random.Random(3)
    words = ["".join(rng.choice("aeinrst éñ中0 ") for _ in range(rng.randint(1, 40))).encode() for _ in range(400)]
    many = vocabulary.many_word_ids(words)
    assert many == [np.array(vocabulary.word_ids(w), "<u4").tobytes() for w in words]


def test_toxicity_learns_and_stands_odd_rows(spark, odd):
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(plain, k=rng.randint(5, 60))
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["nasty", "vilethings", "vilefolk"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "id bigint, text string")
    known = spark.createDataFrame(labels + [(None, 1), (7, None), (99_999, 1)], "id bigint, toxic int")
    model = toxicity.fit(docs, known, ~queries.held_out("id"))
    scores = {r.id: r.score for r in toxicity.scored(docs, model).collect()}
    right = sum((scores[i] >= 0.5) == bool(t) for i, t in labels)
    assert right >= 590
    found = toxicity.scored(odd.withColumn("score", F.lit("x")), model).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)
    nothing = toxicity.fit(docs.limit(0), known.limit(0), F.lit(True))
    assert {r.score for r in toxicity.scored(odd, nothing).collect()} == {0.0}


def test_block_max_finds_the_nearest():
    rng = np.random.default_rng(1)
    n, count = 60, 500
    import pandas as pd

    vectors = [np.sort(rng.choice(n, rng.integers(1, 8), replace=False)) for _ in range(count)]
    kept = pd.DataFrame({"f": vectors, "n": [rng.integers(1, 4, len(f)) for f in vectors]})
    idf = rng.uniform(0.5, 3, n)
    known = toxicity.Known(np.arange(n, dtype=np.uint64))
    model = toxicity.Model(
        known, idf, np.arange(count), np.zeros(count, np.int64), np.ones(2), 0.1,
        *toxicity._index(n, idf, kept), np.zeros(0), np.zeros(0),
    )
    dense = np.zeros((count, n))
    for i, (f, t) in enumerate(zip(kept["f"], kept["n"])):
        dense[i, f] = model.vector(f, t)
    for i in range(0, count, 10):
        best, near = model.nearest(kept["f"][i], model.vector(kept["f"][i], kept["n"][i]), 7, but=i)
        cosine = dense @ dense[i]
        cosine[i] = -1
        assert np.allclose(near, np.sort(cosine)[::-1][: len(near)])


def test_isotonic_rises():
    steps, values = toxicity.isotonic(
        np.array([0.1, 0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1, 0, 1, 1]), np.ones(5)
    )
    assert np.allclose(values, [1 / 3, 1]) and np.allclose(steps, [0.1, 0.3])


def test_ordinal_orders_grades(spark, odd):
    rng = random.Random(9)
    rows, grades = [], []
    for i in range(900):
        grade = i % 4
        words = rng.choices([f"t{grade}x{k}" for k in range(6)] + [f"c{k}" for k in range(60)], k=40)
        rows.append((i, " ".join(words)))
        grades.append((i, grade))
    docs = spark.createDataFrame(rows, "id bigint, text string")
    ratings = spark.createDataFrame(grades + [(None, 2), (5, 9), (6, None)], "id bigint, grade int")
    model = ordinal.fit(docs, ratings, 4, ~queries.held_out("id"))
    assert (np.diff(model.thresholds) > 0).all()
    found = ordinal.graded(docs.join(ratings.filter("grade < 4"), "id"), model).collect()
    assert all(all(a >= b for a, b in zip(r.tails, r.tails[1:])) for r in found)
    assert sum(round(r.expected_grade) == r.grade for r in found) > 0.85 * len(found)
    assert len(ordinal.graded(odd.withColumn("tails", F.lit(0)), model).collect()) == len(odd_rows())
    assert ordinal.fit(docs.limit(0), ratings.limit(0), 3, F.lit(True)).thresholds.tolist() == sorted(
        ordinal.fit(docs.limit(0), ratings.limit(0), 3, F.lit(True)).thresholds.tolist()
    )


@pytest.mark.parametrize("line", ["http://a/ 1.2.3.4 20010203040506 text/html 5", "u v 1.2.3.4 20010203040506 text/html 5"])
def test_arc_lines_of_both_versions(line):
    body = f"{line}\nhello\nbroken line\nhttp://b/ 1.2.3.4 20010203040506 text/plain 200 abc - 0 f.arc 99\nshort"
    first, second = arc.arc_records("x.arc", body.encode(), True)
    assert (first[15], first[13]) == (b"hello", False)
    assert (second[15], second[13]) == (b"short", True)


def test_pages_come_back(spark):
    rows = [
        (1, "http://a b", "<p>é"), (2, None, "<p>é"), (3, "", None), (4, "filedesc://x", ""),
        (5, "dns:x", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", "<p>é"), (6, "u", "x" * 200_000),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    old, new = staged_path(spark, "arc"), staged_path(spark, "warc")
    arc.write_arc(pages, old, row="page_id", url="url", body="html")
    arc.convert(spark, old, new)
    found = arc.read_warc(spark, new).filter("record_type <> 'warcinfo'").collect()
    assert {(r.row, r.payload_bytes) for r in found} == {
        (i, len((h or "").encode())) for i, _, h in rows
    }
    assert all(r.digest_holds for r in found)
    kinds = {r.row: r.record_type for r in found}
    assert kinds[1] == "response" and kinds[2] == kinds[None] == "revisit" and kinds[4] == "revisit"


@pytest.mark.parametrize("entropy, repeats", [(0.99, None), (None, 2.0), (0.9, 3.0), (None, None)])
def test_mix_reaches_its_targets(spark, entropy, repeats):
    rows = [(i, "abcd" * (i % 9), "big" if i % 20 else ("mid" if i % 40 else "small")) for i in range(2000)]
    rows += [(2000, None, None), (2001, "", None), (3, "abcd" * 3, "big")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    tokens = mixing.estimated_tokens("text")
    mixed = mixing.mix(df, "doc_id", "source", tokens, entropy=entropy, repeats=repeats, seed=3)
    read = mixed.groupBy(F.coalesce("source", F.lit("")).alias("s")).agg(
        F.sum(tokens).alias("t"), F.max("epoch").alias("e")
    )
    got = {r.s: r.t for r in read.collect()}
    have = {r.s: r.t for r in df.groupBy(F.coalesce("source", F.lit("")).alias("s")).agg(F.sum(tokens).alias("t")).collect()}
    assert sum(got.values()) <= sum(have.values())
    if repeats is not None:
        assert all(got[s] <= repeats * have[s] for s in got)
    if entropy is None and repeats is None:
        assert got == have
    if entropy == 0.99 and repeats is None:
        share = np.array([t for t in got.values()]) / sum(got.values())
        assert -(share * np.log(share)).sum() / np.log(4) > 0.95
    assert mixing.mix(df.limit(0), "doc_id", "source", tokens).count() == 0


def test_shingles_of_words():
    from meterloom.llm.shingles import shingle_sets

    texts = ["", "a", "A", "a b c d e", "a b c d e f", "A B C D E", "b a c d e", "\x1c\x0ba"]
    raw = [t.encode() for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    sets, bounds = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), ends)
    found = [set(sets[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
    assert [len(f) for f in found] == [0, 1, 1, 1, 2, 1, 1, 1]
    assert found[1] == found[2] and found[3] == found[5] != found[6] and found[3] < found[4]
    assert not re.match(r"\s", "\x00")


def test_toxicity_keeps_every_term(spark):
    """A word in six of 60 toxic examples and in no clean one; too few for any cut-off."""
    rng = random.Random(4)
    plain = [a + b + "rst" for a in "abcdefghij" for b in "klmnopqrst"]
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(plain, k=rng.randint(8, 20))
        if i < 60:
            words.append("scarce" if i < 6 else "nasty")
        rows.append((i, " ".join(words)))
        labels.append((i, int(i < 60)))
    rows += [(900, " ".join(rng.choices(plain, k=9)) + " Scarce"), (901, " ".join(rng.choices(plain, k=9)))]
    docs = spark.createDataFrame(rows, "id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "id bigint, toxic int"), F.lit(True))
    words = {w for _, text in rows[:300] for w in text.lower().split()}
    assert len(model.known.hashes) == len(words)
    scores = {r.id: r.score for r in toxicity.scored(docs.filter("id >= 900"), model).collect()}
    assert scores[900] >= 0.5 > scores[901]


def test_toxicity_ties_share_the_vote(spark):
    """Copies among the labelled rows: the order of classes and ids must not decide."""
    rows = [(i, "some odious words" if i < 100 else f"calm number{i}") for i in range(200)]
    for toxic in (range(30, 100), range(70)):
        labels = [(i, int(i in toxic)) for i in range(200)]
        docs = spark.createDataFrame(rows, "id bigint, text string")
        model = toxicity.fit(docs, spark.createDataFrame(labels, "id bigint, toxic int"), F.lit(True))
        _, feature, times = model.known.counts(*text_bytes(pa.array([rows[0][1]])))
        best, near = model.nearest(feature, model.vector(feature, times), toxicity.NEIGHBOURS)
        assert abs(model.vote(best, near) - 0.7) < 0.02


def test_archives_keep_pages_of_any_url(spark):
    blank = ["\u00a0", "\u3000", "\u2028", "\x1c", "\x00", "\x85", "\t", " ", "\r\n"]
    rows = [(i, f"{c}http://a/{c}b", f"page {i % 10}") for i, c in enumerate(blank + ["", "\ufeff"])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    old, new = staged_path(spark, "arc"), staged_path(spark, "warc")
    arc.write_arc(pages, old, row="page_id", url="url", body="html")
    read = arc.read_arc(spark, old).collect()
    assert {r.passed_over for r in read} == {0}
    urls = {r.row: r.url for r in read}
    assert urls[1] == "%E3%80%80http://a/%E3%80%80b" and urls[3] == "%1Chttp://a/%1Cb"
    arc.convert(spark, old, new)
    found = arc.read_warc(spark, new).filter("record_type <> 'warcinfo'").collect()
    assert sorted(r.row for r in found) == list(range(len(rows)))


def test_archive_lines_passed_over_are_counted():
    body = "odd\n\u3000http://a/ 0.0.0.0 20200101000000 text/plain 2\nhi\nodd\n\nodd\n"
    (found,) = arc.arc_records("x.arc", body.encode(), True)
    assert dict(zip(arc.ARC_SCHEMA.names, found))["passed_over"] == 3
    with pytest.raises(ValueError):
        list(arc.arc_records("x.arc", b"odd\n", True))


def test_the_token_stage_needs_one_worker_a_task(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    found = corpus_pipeline.to_tokens(spark, docs, "")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.n_tokens > 0) for r in found.collect()) == [(1, True), (2, False)]
