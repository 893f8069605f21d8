"""Flat metrics and tags out of nested reports, and nested reports out of rows.

A flat report is a table ``run_id, name, metric, tag``: exactly one of ``metric`` and
``tag`` is set. Values that are unknown have no row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StructField

from meterloom.functions.replies import read_body
from meterloom.functions.text import strip
from meterloom.operators.logs import error_excerpt, tail_text
from meterloom.operators.serving import LEVEL_METRICS

NO_KNEE = "no level met the p95 TTFT SLO"
GOOD_ENDING = "swept"


def _entry(name: Column, metric: Column | None = None, tag: Column | None = None) -> Column:
    return F.struct(
        name.alias("name"),
        (F.lit(None) if metric is None else metric).cast("double").alias("metric"),
        (F.lit(None) if tag is None else tag).cast("string").alias("tag"),
    )


def _spread(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    said = (F.col("_e.metric").isNotNull()) | (F.col("_e.tag").isNotNull())
    return (
        entries.select(*keys, F.explode("_entries").alias("_e"))
        .filter(said)
        .select(*keys, "_e.name", "_e.metric", "_e.tag")
    )


def flatten_sweeps(
    reports: DataFrame, keys: Sequence[str] = ("run_id",), prefix: str = "bench."
) -> DataFrame:
    """D2, D3 and D4 over nested sweep reports. One row in, its entries out; no shuffle."""
    counted = F.filter(
        F.coalesce("levels", F.array().cast(reports.schema["levels"].dataType)),
        lambda level: level["concurrency"].isNotNull(),
    )

    def of_level(level: Column) -> Column:
        stem = F.concat(F.lit(f"{prefix}c"), level["concurrency"].cast("string"), F.lit("."))
        errors = F.when(F.size(level["errors"]) > 0, F.to_json(level["errors"]))
        return F.array(
            *[
                _entry(F.concat(stem, F.lit(field)), metric=level[field])
                for field in LEVEL_METRICS
            ],
            _entry(F.concat(stem, F.lit("errors")), tag=errors),
        )

    failed = F.aggregate(
        counted,
        F.lit(0).cast("bigint"),
        lambda total, level: total + F.coalesce(level["failed"], F.lit(0)),
    )
    named = [
        _entry(F.lit(f"{prefix}{c}"), tag=F.nullif(F.col(c), F.lit("")))
        for c in ("model", "base_url")
    ]
    numbers = [
        _entry(F.lit(f"{prefix}{c}"), metric=F.col(c))
        for c in ("max_tokens", "ttft_slo_s", "peak_output_tok_per_s", "knee_concurrency")
    ]
    no_knee = F.when(F.col("knee_concurrency").isNull(), F.lit(NO_KNEE))
    head = F.array(
        *named,
        *numbers,
        _entry(F.lit(f"{prefix}knee_concurrency_none"), tag=no_knee),
        _entry(F.lit(f"{prefix}levels"), metric=F.coalesce(F.size("levels"), F.lit(0))),
        _entry(F.lit(f"{prefix}failed_total"), metric=failed),
    )
    levels = F.flatten(F.transform(counted, of_level))
    return _spread(reports.select(*keys, F.concat(head, levels).alias("_entries")), keys)


def level_metrics(
    levels: DataFrame, keys: Sequence[str] = ("deployment",), prefix: str = "bench."
) -> DataFrame:
    """D2 over level rows: ``keys, name, metric``."""
    numbers = levels.select(
        *keys, "concurrency", *[F.col(c).cast("double").alias(c) for c in LEVEL_METRICS]
    )
    long = numbers.unpivot([*keys, "concurrency"], list(LEVEL_METRICS), "field", "metric")
    name = F.concat(
        F.lit(f"{prefix}c"), F.col("concurrency").cast("string"), F.lit("."), F.col("field")
    )
    return long.filter(F.col("metric").isNotNull()).select(*keys, name.alias("name"), "metric")


def flatten_replies(
    replies: DataFrame,
    keys: Sequence[str] = ("run_id",),
    body: str = "body",
    prefix: str = "bench.smoke.",
) -> DataFrame:
    """Usage metrics and reply text of one chat reply per run."""
    read = replies.withColumn("_r", read_body(F.col(body)))
    fields = ("prompt_tokens", "completion_tokens", "total_tokens")
    content = F.get(F.col("_r.choices"), 0)["message"]["content"]
    entries = F.array(
        *[_entry(F.lit(f"{prefix}{f}"), metric=F.col(f"_r.usage.{f}")) for f in fields],
        _entry(F.lit(f"{prefix}reply"), tag=F.nullif(content, F.lit(""))),
    )
    return _spread(read.select(*keys, entries.alias("_entries")), keys)


def flatten_comparison(
    compared: DataFrame, keys: Sequence[str] = ("run_id",), prefix: str = "eval."
) -> DataFrame:
    """``eval.{task}.{base,tuned,delta}`` metrics; unknown values have no row."""
    stem = F.concat(F.lit(prefix), F.translate("task", "/", "_"), F.lit("."))
    entries = F.array(
        *[
            _entry(F.concat(stem, F.lit(field)), metric=F.col(field))
            for field in ("base", "tuned", "delta")
        ]
    )
    return _spread(compared.select(*keys, entries.alias("_entries")), keys)


def identity_tags(
    runs: DataFrame, keys: Sequence[str] = ("run_id",), prefix: str = "eval."
) -> DataFrame:
    """What was evaluated, as three tags per run."""
    entries = F.array(
        _entry(F.lit(f"{prefix}model"), tag=F.coalesce("model", F.lit(""))),
        _entry(F.lit(f"{prefix}adapter"), tag=F.coalesce("adapter", F.lit("None"))),
        _entry(F.lit(f"{prefix}benchmarks"), tag=F.array_join("benchmarks", ",")),
    )
    return _spread(runs.select(*keys, entries.alias("_entries")), keys)


def split_metrics_and_tags(
    report: DataFrame, keys: Sequence[str] = ("run_id",), prefix: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Numeric columns become metrics; booleans and everything else become tags.

    Decided from the schema, before any row is read.
    """
    fields = [f for f in report.schema.fields if f.name not in keys]
    numeric = [f for f in fields if isinstance(f.dataType, NumericType)]
    others = [f for f in fields if not isinstance(f.dataType, NumericType)]

    def number(field: StructField) -> Column:
        return F.col(field.name).cast("double").alias(field.name)

    def text(field: StructField) -> Column:
        said = F.col(field.name).cast("string")
        shown = F.initcap(said) if isinstance(field.dataType, BooleanType) else said
        return shown.alias(field.name)

    def long(chosen: list[StructField], read: Callable, value: str, kind: str) -> DataFrame:
        if not chosen:
            nothing = report.select(*keys).limit(0)
            return nothing.select(
                *keys, F.lit("").alias("name"), F.lit(None).cast(kind).alias(value)
            )
        names = [f.name for f in chosen]
        picked = report.select(*keys, *[read(f) for f in chosen])
        return (
            picked.unpivot(list(keys), names, "name", value)
            .filter(F.col(value).isNotNull())
            .withColumn("name", F.concat(F.lit(prefix), "name"))
        )

    return (
        long(numeric, number, "metric", "double"),
        long(others, text, "tag", "string"),
    )


def metrics_of(flat: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    return flat.filter(F.col("metric").isNotNull()).select(*keys, "name", "metric")


def tags_of(flat: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    return flat.filter(F.col("tag").isNotNull()).select(*keys, "name", "tag")


def build_report(
    runs: DataFrame,
    sweeps: DataFrame | None = None,
    replies: DataFrame | None = None,
    log_lines: DataFrame | None = None,
    tail_lines: int = 40,
) -> DataFrame:
    """Everything known about each run, as one flat table.

    ``runs`` holds ``run_id, status``. Every part is optional, and so is every run within
    a part. Logs are read only for runs that ended badly; their file id is the run id.
    """
    status = runs.filter(F.coalesce("status", F.lit("")) != "")
    flat = _spread(
        status.select(
            "run_id", F.array(_entry(F.lit("bench.status"), tag=F.col("status"))).alias("_entries")
        ),
        ["run_id"],
    )
    if sweeps is not None:
        flat = flat.unionByName(flatten_sweeps(sweeps))
    if replies is not None:
        flat = flat.unionByName(flatten_replies(replies))
    if log_lines is not None:
        failed = status.filter(F.col("status") != GOOD_ENDING).select(
            F.col("run_id").alias("file_id")
        )
        bad = log_lines.join(failed, "file_id", "left_semi")
        for name, found in (
            ("bench.vllm_cause", error_excerpt(bad)),
            ("bench.vllm_tail", tail_text(bad, tail_lines)),
        ):
            flat = flat.unionByName(
                found.select(
                    F.col("file_id").alias("run_id"),
                    F.lit(name).alias("name"),
                    F.lit(None).cast("double").alias("metric"),
                    strip(F.col("excerpt")).alias("tag"),
                ).filter(F.col("tag") != "")
            )
    return flat


SWEEP_SETTINGS = {
    "base_url": "string",
    "model": "string",
    "max_tokens": "int",
    "chat_template_kwargs": "map<string, boolean>",
    "ttft_slo_s": "double",
}


def error_maps(histogram: DataFrame, level: Sequence[str]) -> DataFrame:
    """The error counts of a level as one map, the form a sweep report holds them in."""
    return histogram.groupBy(*level).agg(
        F.map_from_entries(F.collect_list(F.struct("error", "n"))).alias("errors")
    )


def sweep_reports(
    levels: DataFrame,
    errors: DataFrame,
    knees: DataFrame,
    totals: DataFrame,
    settings: DataFrame | None = None,
    by: Sequence[str] = ("deployment",),
) -> DataFrame:
    """K5: one nested document per sweep, its levels sorted by concurrency.

    ``settings`` holds, for each sweep, what it was asked to do: ``SWEEP_SETTINGS``. Without
    it these are null.
    A document lists the levels of one sweep, a handful of aggregate rows, never requests.
    """
    none = F.create_map().cast("map<string,bigint>")
    nested = (
        levels.join(error_maps(errors, [*by, "concurrency"]), [*by, "concurrency"], "left")
        .withColumn("errors", F.coalesce("errors", none))
        .groupBy(*by)
        .agg(
            F.array_sort(
                F.collect_list(F.struct("concurrency", F.struct(*LEVEL_METRICS, F.to_json("errors").alias("errors")).alias("level")))
            ).alias("levels")
        )
    )
    if settings is None:
        unknown = {c: F.lit(None).cast(kind) for c, kind in SWEEP_SETTINGS.items()}
        settings = nested.select(*by).withColumns(unknown)
    known = nested.join(settings, list(by), "left").join(knees, list(by), "left")
    return known.join(totals, list(by), "left").select(
        *by,
        *SWEEP_SETTINGS,
        F.transform(
            "levels",
            lambda l: F.struct(
                l["concurrency"].alias("concurrency"),
                *[l["level"][m].alias(m) for m in LEVEL_METRICS],
                F.from_json(l["level"]["errors"], "map<string,bigint>").alias("errors"),
            ),
        ).alias("levels"),
        "knee_concurrency",
        "peak_output_tok_per_s",
    )


def evaluation_reports(
    runs: DataFrame, compared: DataFrame, keys: Sequence[str] = ("run_id",)
) -> DataFrame:
    """K4: identity, base scores, tuned scores and comparison as one document per run.

    A document lists the tasks of one evaluation, not its questions.
    """
    row = F.struct("task", "base", "tuned", "delta", "delta_pct")
    nested = compared.groupBy(*keys).agg(
        F.array_sort(F.collect_list(row)).alias("comparison")
    )

    def scores(side: str) -> Column:
        known = F.filter("comparison", lambda r: r[side].isNotNull())
        return F.map_from_entries(
            F.transform(known, lambda r: F.struct(r["task"], r[side]))
        ).alias(side)

    return runs.join(nested, list(keys), "left").select(
        *runs.columns, scores("base"), scores("tuned"), "comparison"
    )
