"""Temperature mixing: sources in the shares p^a / sum(p^a), realised within a token budget.

The exponent a is found by bisection: a = 1 keeps the natural shares, a = 0 makes all
sources equal. The mix is a sequence of epochs for every source, each a permutation of its
documents in blocks; the last epoch ends where the source's budget does. Built from
DataFrame functions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.shared import checkpointed

SECTIONS = 256
ROUNDS = 3
BLOCK_SHIFT = 50  # a place has 60 bits: 1024 blocks
SOURCES_SENT = 100_000


def estimated_tokens(text: str) -> Column:
    """A quarter of the UTF-8 bytes, and one: at least one token for any row."""
    return F.expr(f"coalesce(octet_length(`{text}`), 0) div 4 + 1").cast("bigint")


def find_exponent(
    shares: DataFrame, total: int, budget: int, entropy: float | None, repeats: float | None
) -> float:
    """The largest exponent in [0, 1] whose shares reach ``entropy`` (as a part of the
    largest possible), raised as far as needed for no source to be read over ``repeats``
    times.

    Entropy falls and the most repeated source is read less as the exponent rises, so each
    target splits [0, 1] in two. A round tests 256 points of the bracket at once, over the
    table of sources; three rounds leave 2^-24. Without a target, 1.
    """

    def search(reached: Column, least: bool) -> float:
        low, width = 0.0, 1.0
        for _ in range(ROUNDS):
            tried = shares.select(
                F.explode(F.sequence(F.lit(0), F.lit(SECTIONS))).alias("i"),
                F.log(F.col("tokens") / F.lit(float(total))).alias("l"),
            ).withColumn("w", F.exp((F.lit(low) + F.col("i") * F.lit(width / SECTIONS)) * F.col("l")))
            facts = tried.groupBy("i").agg(
                F.log(F.sum("w")).alias("log_z"),
                F.sum(F.col("w") * F.log("w")).alias("wlw"),
                F.sum("w").alias("z"),
                F.max(F.col("w") / F.exp("l")).alias("over"),
                F.count(F.lit(1)).alias("n"),
            )
            good = facts.filter(reached)
            found = good.agg((F.min if least else F.max)("i")).first()[0]
            if found is None:
                return 1.0 if least else 0.0
            start = found - 1 if least else found
            if least and found == 0:
                return low
            if not least and found == SECTIONS:
                return low + width
            low, width = low + start * width / SECTIONS, width / SECTIONS
        return low + (width if least else 0.0)

    exponent = 1.0
    if entropy is not None:
        has = F.col("log_z") - F.col("wlw") / F.col("z")
        exponent = search(has >= F.lit(entropy) * F.log(F.col("n").cast("double")) - 1e-12, False)
    if repeats is not None:
        read = F.col("over") / F.col("z") * F.lit(budget / total)
        exponent = max(exponent, search(read <= F.lit(float(repeats)), True))
    return exponent


def place(identity: str, epoch: Column, seed: int) -> Column:
    """Where a document stands in an epoch: 60 bits of a hash of seed, epoch and id."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col(identity).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def mix_plan(
    df: DataFrame,
    identity: str,
    source: str,
    tokens: Column,
    *,
    budget: int | None = None,
    entropy: float | None = 0.95,
    repeats: float | None = 4.0,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame, float]:
    """Rows with ``_source``, ``_tokens``; per source its weight, whole epochs and the last
    place in the epoch after them; and the exponent.

    A third of all rows may be of one source: token sums are combined before the shuffle,
    and to find the last place a source is cut into 1024 blocks by place, of which only the
    one where the budget ends is ordered.
    """
    rows = df.select(
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
        F.col(identity).alias("_identity"),
        tokens.alias("_tokens"),
    )
    shares = checkpointed(rows.groupBy("_source").agg(F.sum("_tokens").alias("tokens")))
    count, total = shares.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    budget = total if budget is None else budget
    if not count or not budget:
        empty = shares.select(
            "_source", "tokens", *[F.lit(0).cast(t).alias(n) for n, t in
            (("weight", "double"), ("whole", "bigint"), ("left", "bigint"), ("last", "bigint"))]
        ).withColumn("last", F.lit(-1).cast("bigint"))
        return rows, empty, 1.0
    exponent = find_exponent(shares, total, budget, entropy, repeats)
    raw = F.exp(F.lit(exponent) * F.log(F.col("tokens") / F.lit(float(total))))
    z = shares.agg(F.sum(raw)).first()[0]
    # A share that should be a whole number of tokens may come out a hair below it.
    wanted = F.floor(raw / F.lit(z) * F.lit(float(budget)) + 1e-6).cast("bigint")
    weights = (
        shares.withColumn("weight", raw / F.lit(z))
        .withColumn("_wanted", wanted)
        .withColumn("whole", F.expr("_wanted div tokens"))
        .withColumn("left", F.expr("_wanted % tokens"))
        .drop("_wanted")
    )
    known = F.broadcast(weights) if count <= SOURCES_SENT else weights
    placed = rows.join(known.select("_source", "whole", "left"), "_source").select(
        "_source", "left", "_tokens", place("_identity", F.col("whole"), seed).alias("_place")
    ).withColumn("_block", F.shiftright("_place", BLOCK_SHIFT))
    blocks = placed.groupBy("_source", "_block").agg(
        F.sum("_tokens").alias("_sum"), F.first("left").alias("left")
    )
    so_far = Window.partitionBy("_source").orderBy("_block")
    ends = (
        blocks.withColumn("_after", F.sum("_sum").over(so_far))
        .withColumn("_before", F.col("_after") - F.col("_sum"))
        .filter((F.col("_before") <= F.col("left")) & (F.col("_after") > F.col("left")))
        .select("_source", "_block", "_before")
    )
    inside = Window.partitionBy("_source", "_block").orderBy("_place")
    # Rows of one place (copies of an id) are peers of the window: all are in or none.
    last = (
        placed.join(ends, ["_source", "_block"])
        .withColumn("_sum", F.col("_before") + F.sum("_tokens").over(inside))
        .filter(F.col("_sum") <= F.col("left"))
        .groupBy("_source")
        .agg(F.max("_place").alias("_last"))
    )
    starts = ends.select("_source", (F.shiftleft("_block", BLOCK_SHIFT) - 1).alias("_start"))
    plan = (
        weights.join(starts, "_source", "left")
        .join(last, "_source", "left")
        .withColumn("last", F.coalesce("_last", "_start", F.lit(-1).cast("bigint")))
        .select("_source", "tokens", "weight", "whole", "left", "last")
    )
    return rows, checkpointed(plan), exponent


def mix(
    df: DataFrame,
    identity: str,
    source: str,
    tokens: Column,
    *,
    budget: int | None = None,
    entropy: float | None = 0.95,
    repeats: float | None = 4.0,
    seed: int = 0,
) -> DataFrame:
    """The rows of ``df``, each as often as the mix reads it, with ``epoch``, ``block``, ``place``.

    ``budget`` tokens in all (as many as there are, if not given). Reading epoch by epoch,
    block by block, in the order of ``place`` is a permutation of each epoch; no source
    gets more than its budget. A null source counts as "". Rows with the same id have the
    same place. An empty table, or no budget, gives no rows. Columns of these three names
    are replaced; texts are not shuffled, but joined with the table of sources, which is
    sent to all executors only if it has up to 100,000 rows.
    """
    df = df.drop("epoch", "block", "place", "_source")
    _, plan, _ = mix_plan(
        df, identity, source, tokens, budget=budget, entropy=entropy, repeats=repeats, seed=seed
    )
    known = plan.select("_source", "whole", "last")
    if known.count() <= SOURCES_SENT:
        known = F.broadcast(known)
    named = df.withColumn("_source", F.coalesce(F.col(source).cast("string"), F.lit("")))
    copies = F.sequence(F.lit(0).cast("bigint"), F.col("whole"))
    return (
        named.join(known, "_source")
        .withColumn("epoch", F.explode(copies))
        .withColumn("place", place(identity, F.col("epoch"), seed))
        .filter((F.col("epoch") < F.col("whole")) | (F.col("place") <= F.col("last")))
        .withColumn("block", F.shiftright("place", BLOCK_SHIFT).cast("int"))
        .select(*df.columns, "epoch", "block", "place")
    )


def mix_sql(table: str, entropy: float, repeats: float, seed: int) -> str:
    """DuckDB SQL for the ids, epochs and places of :func:`mix` with the budget of all tokens."""
    rounds = []
    for kind, sign, pick in (("e", ">=", "max"), ("r", "<=", "min")):
        back = 0 if kind == "e" else 1
        test = (
            f"ln(sum(w)) - sum(w * ln(w)) / sum(w) >= {entropy!r} * ln(count(*)) - 1e-12"
            if kind == "e"
            else f"max(w / exp(l)) / sum(w) {sign} {repeats!r}"
        )
        rounds.append(f"{kind}0 AS (SELECT 0.0::DOUBLE AS low, 1.0::DOUBLE AS width, NULL::DOUBLE AS done)")
        for k in range(1, ROUNDS + 1):
            edge = (
                f"CASE WHEN i IS NULL THEN 0.0 WHEN i = {SECTIONS} THEN low + width END"
                if kind == "e"
                else "CASE WHEN i IS NULL THEN 1.0 WHEN i = 0 THEN low END"
            )
            rounds.append(
                f"""{kind}{k} AS (SELECT low + (coalesce(i, 0) - {back}) * width / {SECTIONS} AS low,
                width / {SECTIONS} AS width, coalesce(done, {edge}) AS done
                FROM {kind}{k - 1}, (SELECT {pick}(i) AS i FROM (SELECT i FROM (
                  SELECT i, l, exp((low + i * (width / {SECTIONS})) * l) AS w
                  FROM shares, {kind}{k - 1}, range({SECTIONS + 1}) AS g(i)) GROUP BY i HAVING {test})))"""
            )
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(source, '') AS source,
        coalesce(strlen(text), 0) // 4 + 1 AS tokens FROM {table}),
    sums AS (SELECT source, sum(tokens)::BIGINT AS t FROM docs GROUP BY source),
    shares AS (SELECT source, t, ln(t / (SELECT sum(t) FROM sums)::DOUBLE) AS l FROM sums),
    {", ".join(rounds)},
    a AS (SELECT greatest((SELECT coalesce(done, low) FROM e{ROUNDS}),
        (SELECT coalesce(done, low + width) FROM r{ROUNDS})) AS a),
    wanted AS (SELECT source, t, floor(exp(a * l) / (SELECT sum(exp(a * l)) FROM shares, a)
        * (SELECT sum(t) FROM sums)::DOUBLE + 1e-6)::BIGINT AS wanted FROM shares, a),
    plan AS (SELECT source, wanted // t AS whole, wanted % t AS rest FROM wanted),
    copies AS (SELECT doc_id, source, tokens, whole, rest, unnest(range(whole + 1)) AS epoch
        FROM docs JOIN plan USING (source)),
    placed AS (SELECT *, ('0x' || substr(md5('{seed}:' || epoch || ':' || doc_id), 1, 15))::BIGINT
        AS place FROM copies),
    cut AS (SELECT *, sum(tokens) OVER (PARTITION BY source, epoch ORDER BY place
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS read FROM placed)
    SELECT doc_id, source, tokens::BIGINT AS tokens, epoch::BIGINT AS epoch,
        (place >> {BLOCK_SHIFT})::INTEGER AS block, place
    FROM cut WHERE epoch < whole OR read <= rest
    """
