"""The registered queries of this package: thin calls of the operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import (
    adsampling,
    arc,
    bpe,
    hilbert,
    masks,
    minmax,
    mixing,
    ordinal,
    pii,
    rabitq,
    resample,
    suffixes,
    toxicity,
)
from meterloom.llm.shared import staged_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
QUERIES = {}
ORACLES = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


@_query()
def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 100 bytes that start earlier."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    cut = suffixes.without_repeats(docs, "doc_id")
    return cut.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        "n_removed",
        F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(('0x' || substr(hex, {1 + 5 * i}, 5))"
    f"::BIGINT >> {15 - 5 * j} & 31 AS INTEGER), 1)"
    for i in range(8)
    for j in range(4)
)


@_query(f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
    q AS (SELECT page_id, strlen(body) AS n, hex, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
    SELECT page_id, n::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM q
""")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to ARC, converted to WARC and read back."""
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    old, new = staged_path(spark, "arc"), staged_path(spark, "warc")
    arc.write_arc(pages, old, row="page_id", url="url", body="html")
    arc.convert(spark, old, new, least_bytes=0)
    records = arc.read_warc(spark, new, payloads=False).filter("record_type <> 'warcinfo'")
    known = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("row").alias("refers_to")
    )
    return records.join(known, "refers_to_id", "left").select(
        F.col("row").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@_query(f"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}),
        '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
        THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3),
        lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (shingle)
        WHERE x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
        WHERE 100 * k >= 75 * (na.n + nb.n - k)),
    walk AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION
        SELECT walk.a, links.b FROM walk JOIN links ON links.a = walk.b),
    c AS (SELECT a AS doc_id, min(b) AS component_id FROM walk GROUP BY a)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id,
        d.doc_id = c.component_id AS kept
    FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
""")
def op3_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return minmax.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id")


@_query("""
    WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v
        FROM embeddings WHERE list_dot_product(embedding, embedding) > 0
        AND NOT isnan(list_sum(embedding)) AND len(list_filter(embedding, lambda x: x IS NULL
        OR isinf(x))) = 0),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.vec_id <> y.vec_id
        WHERE list_dot_product(x.v, y.v)
            / sqrt(list_dot_product(x.v, x.v) * list_dot_product(y.v, y.v)) >= 0.9),
    walk AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION
        SELECT walk.a, links.b FROM walk JOIN links ON links.a = walk.b),
    c AS (SELECT a AS vec_id, min(b) AS component_id FROM walk GROUP BY a),
    n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id,
        vec_id = component_id AS kept
    FROM c LEFT JOIN n USING (vec_id)
""")
def op4_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors."""
    return rabitq.near_vectors(
        _table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", 0.9
    )


def held_out(identity: str):
    """Rows that no label is learnt from: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col(identity).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "id")
    labels = _table(spark, sf_dir, "labels", "doc_id", "toxic").withColumnRenamed("doc_id", "id")
    return toxicity.fit(docs, labels, ~held_out("id"))


@_query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by its nearest labelled examples."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.scored(docs, toxicity_model(spark, sf_dir)).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


@_query()
def op5_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document graded: 0 poor, 1 sound but toxic, 2 sound."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "id")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    ratings = labels.select(
        F.col("doc_id").alias("id"), (F.col("quality") * (2 - F.col("toxic"))).alias("grade")
    )
    model = ordinal.fit(docs, ratings, 3, ~held_out("id"))
    return ordinal.graded(docs, model).select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "expected_grade",
        F.col("tails")[0].alias("p_grade_1_or_better"),
        F.col("tails")[1].alias("p_grade_2_or_better"),
        (F.col("tails")[0] >= 0.5).alias("kept"),
    )


@_query()
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = bpe.encode(docs, TOKENIZER).drop("text")
    decoded = bpe.decode(encoded, TOKENIZER)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


MIX = {"entropy": 0.95, "repeats": 4.0, "seed": 17}


@_query(mixing.mix_sql("documents", **MIX))
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 95 % of the largest entropy of sources, in as many tokens."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    rows = docs.select("doc_id", "source", mixing.estimated_tokens("text").alias("tokens"))
    return mixing.mix(rows, "doc_id", "source", F.col("tokens"), **MIX)


SHARDS = 24


@_query()
def op9_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a Hilbert curve over size, source and language, cut by rows."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    facts = docs.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length(raw) + 8).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    axes = [F.col("size"), hilbert.text_axis("source"), hilbert.text_axis("lang")]
    placed = hilbert.assign_shards(facts, axes, SHARDS, "doc_id")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


@_query()
def op10_adsampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for those whose id is divisible by 20."""
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return adsampling.search(vectors, vectors.filter("vec_id % 20 = 0"), "vec_id", "embedding", 20)


@_query(f"""
    WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
    f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
    n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
    c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
    m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM n, c),
    w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT
        AS w FROM f, c GROUP BY term),
    q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
    s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
        FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
        FROM s WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
""")
def op11_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every item of the benchmark."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    items = _table(spark, sf_dir, "benchmark", "item_id", "text")
    return masks.rank(docs, items, "doc_id", "text", "item_id", "text", 50)


# The CRC of a word, byte by byte and bit by bit.
_CRC = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(range(1, octet_length(encode(word)) + 1),
        lambda i: ('0x' || substr(hex(encode(word)), (2 * i - 1)::BIGINT, 2))::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda k: 0::UBIGINT)),
        lambda r, z: xor(r >> 1, 3988292384::UBIGINT * (r & 1)))))"""


def _words_sql(table: str) -> str:
    return f"""regexp_extract_all(translate(coalesce({table}.text, ''), {_LETTERS}),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""


@_query(f"""
    WITH d AS (SELECT doc_id, {_words_sql("documents")} AS words FROM documents),
    u AS (SELECT doc_id, unnest(words) AS word FROM d),
    v AS (SELECT unnest({_words_sql("benchmark")}) AS word FROM benchmark),
    b AS (SELECT word, ({_CRC} % 10000)::INTEGER AS bucket
        FROM (SELECT DISTINCT word FROM (SELECT word FROM u UNION ALL SELECT word FROM v))),
    s AS (SELECT bucket, count(*) AS s FROM u JOIN b USING (word) GROUP BY ALL),
    t AS (SELECT bucket, count(*) AS t FROM v JOIN b USING (word) GROUP BY ALL),
    g AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE
            * ((SELECT count(*) FROM u) + 10000)::DOUBLE)
            / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM v) + 10000)::DOUBLE)))::BIGINT AS gain
        FROM s FULL JOIN t USING (bucket)),
    w AS (SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
        FROM u JOIN b USING (word) JOIN g USING (bucket) GROUP BY doc_id),
    x AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE)
            / 4294967296)))::BIGINT AS score FROM d LEFT JOIN w USING (doc_id)),
    e AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM x
        WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score,
        CASE WHEN rank <= 10 * (SELECT count(*) FROM e) // 100 THEN rank END AS rank
    FROM x LEFT JOIN e USING (doc_id)
""")
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, and a tenth of them drawn."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    target = _table(spark, sf_dir, "benchmark", "text")
    return resample.resample(docs, target, "doc_id", "text", "text").withColumnRenamed("id", "doc_id")


@_query()
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: by fixed patterns, and what the tagger adds."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = pii.find(docs, "text", pii.fit(docs, "text"))
    joined = pii.joined_spans

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
