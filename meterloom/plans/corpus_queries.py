"""Registered queries: corpus preparation and mix assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions import text as T
from meterloom.functions.messages import normalize_role, to_messages
from meterloom.operators import corpus, mixes
from meterloom.plans import inputs
from meterloom.plans.inputs import (
    LATIN_EXTENDED,
    MIN_RATIO,
    documents,
    instruction_rows,
    sql_canonical,
    sql_layout,
    sql_normalize,
    table,
    with_sql,
)
from meterloom.plans.registry import query
from meterloom.session import stage
from meterloom.sources.readers import as_instructions, read_table, union_sources

WRONG_SCRIPT = "wrong_script"
_LETTERS = f"[^{T.LETTER}]+"
_SCRIPT = f"[^{LATIN_EXTENDED}]+"


def scored_rows(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.score(
        instruction_rows(spark, folder),
        script=LATIN_EXTENDED,
        min_ratio=MIN_RATIO,
        wrong_script=WRONG_SCRIPT,
    )


def _sql_count(text: str, not_class: str) -> str:
    return f"length({inputs.sql_replace(text, not_class)})"


def _sql_words(text: str) -> str:
    return f"[x FOR x IN regexp_split_to_array({text}, '[{T.SPACE}]+') IF x <> '']"


def _sql_repetition(words: str) -> str:
    most = f"list_max(map_values(list_histogram({words})))"
    return f"CASE WHEN len({words}) < 4 THEN 0.0::DOUBLE ELSE {most} / len({words}) END"


SCORED = (
    with_sql("rows_")
    + f""",
    tidy AS (
        SELECT row_id, source, {sql_normalize("instruction")} AS i, {sql_normalize("output")} AS o,
               {sql_canonical("instruction")} AS ci, {sql_canonical("output")} AS co
        FROM rows_),
    measured AS (
        SELECT *, i <> '' AND o <> '' AS both_filled,
               {inputs.sql_replace("i || o", _LETTERS)} AS letters,
               {_sql_words("o")} AS words
        FROM tidy),
    scored AS (
        SELECT row_id, source, i, o, sha1(ci || co) AS dedup_key, [x FOR x IN [
            CASE WHEN i = '' THEN 'empty_instruction' END,
            CASE WHEN o = '' THEN 'empty_output' END,
            CASE WHEN length(o) BETWEEN 1 AND 9 THEN 'output_too_short' END,
            CASE WHEN both_filled AND (letters = '' OR {_sql_count("letters", _SCRIPT)}
                 / length(letters) < {MIN_RATIO}) THEN '{WRONG_SCRIPT}' END,
            CASE WHEN both_filled AND ci = co THEN 'output_echoes_instruction' END,
            CASE WHEN both_filled AND {_sql_repetition("words")} > 0.5 THEN 'repetitive' END
            ] IF x IS NOT NULL] AS reasons
        FROM measured),
    survivors AS (
        SELECT min(row_id) AS row_id FROM scored WHERE len(reasons) = 0 GROUP BY dedup_key)"""
)


@query(
    "read_table",
    "SELECT source, count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY 1",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, f"{folder}/documents.parquet")
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))
    )


@query(
    "union_sources",
    """SELECT doc_id::VARCHAR AS instruction, '' AS input, text AS output, 'docs' AS source
       FROM documents
       UNION ALL SELECT '', '', text, 'turns' FROM conversations""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select(
        F.col("doc_id").alias("instruction"), F.col("text").alias("output")
    )
    turns = table(spark, folder, "conversations").select(
        F.lit(None).cast("string").alias("input"), F.col("text").alias("output")
    )
    return union_sources([as_instructions(docs, "docs"), as_instructions(turns, "turns")])


@query(
    "normalize_text",
    f"""SELECT doc_id, md5({sql_normalize("text")}) AS text_md5,
               length({sql_normalize("text")})::BIGINT AS n_chars FROM documents""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return (
        documents(spark, folder)
        .withColumn("_t", T.normalize_text(F.col("text")))
        .select(
            "doc_id",
            F.md5("_t").alias("text_md5"),
            T.length_chars(F.col("_t")).cast("bigint").alias("n_chars"),
        )
    )


# Letters followed by combining marks, carriage returns and odd spaces, made from the
# given texts, so that composition and layout have something to do on every row.
_ROUGH = "replace(replace(replace(text, 'e', 'e' || chr(769)), 'u', 'u' || chr(776)), ' ', chr(8195))"


@query(
    "normalize_decomposed",
    f"""SELECT doc_id, md5({sql_layout(f"nfc_normalize({_ROUGH} || chr(13) || chr(10) || text)")})
        AS text_md5 FROM documents""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rough = F.col("text")
    for plain, changed in (("e", "é"), ("u", "ü"), (" ", " ")):
        rough = F.replace(rough, F.lit(plain), F.lit(changed))
    rough = F.concat(rough, F.lit("\r\n"), "text")
    return documents(spark, folder).select(
        "doc_id", F.md5(T.normalize_text(rough)).alias("text_md5")
    )


@query(
    "script_ratio",
    f"""SELECT doc_id, round(CASE WHEN letters = '' THEN 0 ELSE
               {_sql_count("letters", _SCRIPT)} / length(letters) END, 6)::DOUBLE AS ratio
        FROM (SELECT doc_id, {inputs.sql_replace("text", _LETTERS)} AS letters FROM documents)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    ratio = T.script_ratio(F.col("text"), LATIN_EXTENDED)
    return documents(spark, folder).select("doc_id", F.round(ratio, 6).alias("ratio"))


@query("dedup_key", f"SELECT doc_id, sha1({sql_canonical('text')}) AS key FROM documents")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", T.dedup_key(F.col("text")).alias("key"))


@query(
    "repetition_ratio",
    f"""SELECT doc_id, round({_sql_repetition("words")}, 6)::DOUBLE AS ratio,
               {_sql_repetition("words")} > 0.5 AS repetitive
        FROM (SELECT doc_id, {_sql_words("text")} AS words FROM documents)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(
        "doc_id",
        F.round(T.repetition_ratio(F.col("text")), 6).alias("ratio"),
        T.is_repetitive(F.col("text"), 0.5).alias("repetitive"),
    )


@query(
    "first_filled",
    f"""SELECT row_id, md5(CASE WHEN regexp_matches(output, '[^{T.SPACE}]') THEN output
               WHEN regexp_matches(instruction, '[^{T.SPACE}]') THEN instruction END) AS first_md5
        FROM ({with_sql("rows_")} SELECT * FROM rows_)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    first = T.first_filled(F.col("output"), F.col("instruction"))
    return instruction_rows(spark, folder).select("row_id", F.md5(first).alias("first_md5"))


@query(
    "normalize_role",
    """SELECT conv_id, turn, CASE WHEN turn % 9 = 5 THEN NULL WHEN role IN ('system') THEN 'system'
              WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role FROM conversations""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    spelled = (
        F.when(F.col("turn") % 9 == 5, F.lit("narrator"))
        .when(F.col("role") == "user", F.when(F.col("conv_id") % 2 == 0, "Human").otherwise("prompter"))
        .when(F.col("role") == "assistant", F.when(F.col("conv_id") % 2 == 0, "GPT").otherwise("bot"))
        .otherwise(F.upper("role"))
    )
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", normalize_role(spelled).alias("role")
    )


@query(
    "quality_reasons",
    SCORED + " SELECT row_id, list_aggregate(reasons, 'string_agg', ',') AS reasons FROM scored",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    joined = F.nullif(F.array_join("reasons", ","), F.lit(""))
    return scored_rows(spark, folder).select("row_id", joined.alias("reasons"))


@query(
    "accepted_rows",
    SCORED
    + " SELECT row_id, source, md5(i) AS instruction_md5, md5(o) AS output_md5 FROM scored"
    " WHERE len(reasons) = 0",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.accepted(scored_rows(spark, folder)).select(
        "row_id",
        "source",
        F.md5("instruction_n").alias("instruction_md5"),
        F.md5("output_n").alias("output_md5"),
    )


@query(
    "rejected_rows",
    SCORED + " SELECT row_id, source, list_aggregate(reasons, 'string_agg', ',') AS reasons,"
    " md5(i) AS instruction_md5, md5(o) AS output_md5 FROM scored WHERE len(reasons) > 0",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.rejected(scored_rows(spark, folder)).select(
        "row_id",
        "source",
        F.array_join("reasons", ",").alias("reasons"),
        F.md5("instruction_n").alias("instruction_md5"),
        F.md5("output_n").alias("output_md5"),
    )


@query(
    "reject_histogram",
    SCORED + """ SELECT reason, count(*)::BIGINT AS n
                 FROM (SELECT unnest(reasons) AS reason FROM scored) GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.reject_histogram(scored_rows(spark, folder))


def unique_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The accepted rows without copies; scored once, and written with the columns asked for."""
    kept = corpus.accepted(scored_rows(spark, folder))
    return corpus.dedup_exact(stage(kept.select("row_id", "source", "dedup_key", *columns), "scored"))


@query(
    "dedup_exact",
    SCORED + " SELECT row_id, source, dedup_key FROM scored JOIN survivors USING (row_id)",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return unique_rows(spark, folder)


@query(
    "corpus_funnel",
    SCORED + """ SELECT source, count(*)::BIGINT AS loaded,
           (count(*) FILTER (WHERE len(reasons) > 0))::BIGINT AS rejected,
           (count(*) FILTER (WHERE len(reasons) = 0))::BIGINT AS kept,
           count(v.row_id)::BIGINT AS "unique",
           ((count(*) FILTER (WHERE len(reasons) = 0)) - count(v.row_id))::BIGINT AS duplicates
       FROM scored LEFT JOIN survivors v USING (row_id) GROUP BY 1""",
)
def corpus_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.funnel(scored_rows(spark, folder))


@query(
    "chat_records",
    SCORED + """ SELECT row_id, '[["user",' || to_json(i) || '],["assistant",' || to_json(o)
        || ']]' AS messages, source FROM scored JOIN survivors USING (row_id)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = unique_rows(spark, folder, "instruction_n", "input", "output_n")
    record = F.from_json(
        "value", "messages array<struct<role:string,content:string>>, source string"
    )
    quoted = F.transform(
        F.col("record.messages"), lambda m: F.to_json(F.array(m["role"], m["content"]))
    )
    return (
        corpus.chat_records(rows)
        .withColumn("record", record)
        .select(
            "row_id",
            F.concat(F.lit("["), F.array_join(quoted, ","), F.lit("]")).alias("messages"),
            F.col("record.source").alias("source"),
        )
    )


@query("capped_rows", with_sql("rows_") + " SELECT row_id, source FROM rows_ ORDER BY row_id LIMIT 50")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.cap_rows(instruction_rows(spark, folder), 50).select("row_id", "source")


@query(
    "preview_rows",
    SCORED + " SELECT row_id, source FROM scored JOIN survivors USING (row_id) ORDER BY 1 LIMIT 5",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.preview(unique_rows(spark, folder).select("row_id", "source"))


# ------------------------------------------------------------------------------ mixes


def mix_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("row_id"), "source", "text"
    )


def registries(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A registry over the sources that occur in the documents."""
    number = F.substring("source", 4, 10).cast("int")
    datasets = (
        table(spark, folder, "documents")
        .select("source")
        .distinct()
        .select(
            F.col("source").alias("key"),
            F.when(number % 4 != 3, number % 4 != 0).alias("commercial_use"),
        )
    )
    mixes_table = datasets.agg(F.sort_array(F.collect_set("key")).alias("datasets")).select(
        F.lit("broad").alias("mix"), "datasets"
    )
    return mixes_table, datasets


_USABLE_SOURCE = "substr(source, 4)::INTEGER % 4 IN (1, 2)"


@query(
    "resolve_mix",
    f"SELECT DISTINCT source AS key, true AS commercial_use FROM documents WHERE {_USABLE_SOURCE}",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    mix_table, datasets = registries(spark, folder)
    return mixes.resolve_mix(mix_table, datasets, "broad").select("key", "commercial_use")


@query(
    "license_gate",
    f"SELECT doc_id AS row_id, source FROM documents WHERE {_USABLE_SOURCE}",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    _, datasets = registries(spark, folder)
    usable = mixes.license_gate(datasets).select(F.col("key").alias("source"))
    return mix_rows(spark, folder).join(usable, "source", "left_semi").select("row_id", "source")


@query(
    "length_window",
    "SELECT doc_id AS row_id FROM documents WHERE length(text) BETWEEN 10 AND 8000",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return mixes.within_length(mix_rows(spark, folder)).select("row_id")


@query(
    "to_messages",
    """SELECT doc_id AS row_id, CASE doc_id % 4
          WHEN 0 THEN 'user:' || lang || chr(10) || 'assistant:' || md5(text)
          WHEN 1 THEN 'user:' || source || chr(10) || chr(10) || lang || chr(10)
                      || 'assistant:' || md5(text)
          WHEN 2 THEN 'user:' || source || chr(10) || 'assistant:' || md5(text)
          END AS rendered FROM documents""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    kind, digest = F.col("doc_id") % 4, F.md5("text")
    turn = "struct<from:string,value:string>"

    def say(role: str, value) -> F.col:
        return F.struct(F.lit(role).alias("from"), value.alias("value")).cast(turn)

    rows = documents(spark, folder).select(
        F.col("doc_id").alias("row_id"),
        F.when(
            kind == 0,
            F.array(say("human", F.col("lang")), say("narrator", digest), say("gpt", digest)),
        )
        .when(kind == 3, F.array(say("human", F.col("lang")), say("gpt", F.lit("  "))))
        .alias("conversations"),
        F.when(kind == 2, F.lit("not a list")).alias("conversation"),
        F.when(kind != 0, F.col("source")).alias("prompt"),
        F.when(kind == 1, F.col("lang")).alias("context"),
        F.when(kind != 0, digest).alias("answer"),
    )
    lines = F.transform(
        to_messages(rows.schema), lambda m: F.concat_ws(":", m["role"], m["content"])
    )
    return rows.select("row_id", F.array_join(lines, "\n").alias("rendered"))


@query(
    "render_rows",
    f"""{with_sql("rows_")} SELECT row_id, md5(instruction || chr(10) || output) AS text_md5
        FROM rows_ WHERE regexp_matches(instruction, '[^{T.SPACE}]')
        AND regexp_matches(output, '[^{T.SPACE}]')
        AND length(instruction) + length(output) + 1 BETWEEN 10 AND 8000""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rendered = mixes.render_rows(instruction_rows(spark, folder), keep=["row_id"])
    return mixes.within_length(rendered).select("row_id", F.md5("text").alias("text_md5"))


@query(
    "assemble_turns",
    f"""SELECT conv_id, count(*)::BIGINT AS n_turns,
               length(string_agg(text, chr(10) ORDER BY turn))::BIGINT AS n_chars,
               md5(string_agg(text, chr(10) ORDER BY turn)) AS text_md5
        FROM conversations WHERE regexp_matches(text, '[^{T.SPACE}]') GROUP BY 1
        HAVING count(*) >= 2
           AND length(string_agg(text, chr(10) ORDER BY turn)) BETWEEN 10 AND 2000""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return mixes.assemble_turns(turns, max_chars=2000).select(
        "conv_id", "n_turns", "n_chars", F.md5("text").alias("text_md5")
    )


_SHUFFLE_SQL = "md5('42:' || doc_id)"
_CAPPED = """WITH capped AS (
        SELECT * FROM documents WHERE length(text) BETWEEN 10 AND 4000
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5)"""


@query("cap_per_source", _CAPPED + " SELECT doc_id AS row_id, source FROM capped")
def _(spark: SparkSession, folder: str) -> DataFrame:
    capped = mixes.cap_per_source(mix_rows(spark, folder), 5, max_chars=4000, block_rows=64)
    return capped.select("row_id", "source")


@query(
    "take_shuffled",
    f"SELECT doc_id AS row_id, source FROM documents ORDER BY {_SHUFFLE_SQL} LIMIT 60",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return mixes.take_shuffled(mix_rows(spark, folder), 60).select("row_id", "source")


@query(
    "seeded_shuffle",
    f"SELECT doc_id AS row_id, {_SHUFFLE_SQL} AS place FROM documents",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return mixes.seeded_shuffle(mix_rows(spark, folder)).select(
        "row_id", mixes.shuffle_key().alias("place")
    )


@query(
    "load_mix",
    f"""WITH chosen AS (SELECT * FROM documents WHERE {_USABLE_SOURCE}),
    share AS (SELECT 70 // count(DISTINCT source) AS cap FROM chosen),
    capped AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
        FROM chosen, share WHERE length(text) BETWEEN 10 AND 8000)
    SELECT doc_id AS row_id, source FROM capped WHERE rn <= cap
    ORDER BY {_SHUFFLE_SQL} LIMIT 70""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    mix_table, datasets = registries(spark, folder)
    entries = mixes.resolve_mix(mix_table, datasets, "broad")
    return mixes.load_mix(mix_rows(spark, folder), entries, max_samples=70).select(
        "row_id", "source"
    )


@query(
    "concat_parts",
    """SELECT doc_id AS row_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang,
              CASE WHEN doc_id % 2 = 1 THEN source END AS source FROM documents""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).withColumnRenamed("doc_id", "row_id")
    return mixes.concat_parts(
        [
            rows.filter(F.col("row_id") % 2 == 0).select("row_id", "lang"),
            rows.filter(F.col("row_id") % 2 == 1).select("row_id", "source"),
        ]
    )
