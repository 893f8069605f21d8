"""Training-mix assembly: license gate, per-source caps, seeded shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions.messages import normalize_role, render_plain, to_messages
from meterloom.functions.text import is_blank
from meterloom.operators.once import computed_once
from meterloom.operators.ordered import BLOCK_ROWS, measured, take_first

DEFAULT_MIN_CHARS = 10
DEFAULT_MAX_CHARS = 8000
DEFAULT_SEED = 42


def license_gate(datasets: DataFrame, allow_noncommercial: bool = False) -> DataFrame:
    """Commercially usable entries; an entry that does not say is not usable."""
    if allow_noncommercial:
        return datasets
    return datasets.filter(F.coalesce(F.col("commercial_use"), F.lit(False)))


def resolve_mix(
    mixes: DataFrame, datasets: DataFrame, mix: str, *, allow_noncommercial: bool = False
) -> DataFrame:
    """The dataset entries of a named mix, after the license gate.

    Registries are configuration, so mistakes in them are raised here, before any corpus
    is read: an unknown mix, a key without an entry, a mix with nothing left.
    """
    wanted = mixes.filter(F.col("mix") == mix).select(
        F.posexplode("datasets").alias("place", "key")
    )
    if wanted.isEmpty():
        raise KeyError(f"unknown mix {mix!r}")
    stray = wanted.join(datasets, "key", "left_anti").select("key").first()
    if stray:
        raise KeyError(f"mix {mix!r} references unknown dataset {stray['key']!r}")
    chosen = license_gate(wanted.join(datasets, "key"), allow_noncommercial)
    if chosen.isEmpty():
        raise ValueError(f"mix {mix!r} selected no datasets after license filtering")
    return chosen


def render_rows(
    rows: DataFrame, render: Callable[[Column], Column] = render_plain, keep: Sequence[str] = ()
) -> DataFrame:
    """One ``text`` per row of any schema; unusable rows get null.

    ``render`` maps the messages column to text and may be a vectorised UDF. One on Arrow
    arrays needs less memory than one on pandas strings: a batch holds up to 10,000 texts.
    """
    with_messages = computed_once(rows, list(keep), messages=to_messages(rows.schema))
    text = F.when(F.col("messages").isNotNull(), render(F.col("messages")))
    return computed_once(with_messages.withColumn("_text", text), list(keep), text=F.col("_text"))


def within_length(
    rows: DataFrame,
    min_chars: int = DEFAULT_MIN_CHARS,
    max_chars: int = DEFAULT_MAX_CHARS,
    text: str = "text",
) -> DataFrame:
    """Rows whose text has between ``min_chars`` and ``max_chars`` code points."""
    return rows.filter(F.length(text).between(min_chars, max_chars))


def assemble_turns(
    turns: DataFrame,
    conversation: str = "conv_id",
    *,
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    min_chars: int = DEFAULT_MIN_CHARS,
    max_chars: int = DEFAULT_MAX_CHARS,
) -> DataFrame:
    """P5, P6 and P7 for conversations stored one turn per row.

    The joined length is the sum of the turn lengths plus the newlines, so conversations
    outside the window are dropped before any turn is gathered. What is then gathered
    holds at most ``max_chars`` characters, however long the longest conversation is.
    """
    usable = turns.select(
        conversation,
        turn,
        normalize_role(F.col(role)).alias("role"),
        F.col(content).alias("content"),
    ).filter(F.col("role").isNotNull() & ~is_blank(F.col("content")))
    fitting = (
        usable.groupBy(conversation)
        .agg(
            F.count(F.lit(1)).alias("n_turns"),
            (F.sum(F.length("content")) + F.count(F.lit(1)) - 1).alias("n_chars"),
        )
        .filter((F.col("n_turns") >= 2) & F.col("n_chars").between(min_chars, max_chars))
    )
    ordered = F.array_sort(F.collect_list(F.struct(turn, "role", "content")))
    # An overlong conversation finds no partner, but its turns still reach this join. The
    # shuffle after it leaves adaptive execution free to split it; what it moves is small
    # and bounded per conversation.
    return (
        usable.join(fitting, conversation)
        .repartition(conversation)
        .groupBy(conversation, "n_turns", "n_chars")
        .agg(ordered.alias("_turns"))
        .select(
            conversation,
            "n_turns",
            "n_chars",
            F.transform("_turns", lambda t: F.struct(t["role"], t["content"])).alias(
                "messages"
            ),
        )
        .withColumn("text", render_plain(F.col("messages")))
    )


def per_source_share(max_samples: int, n_sources: int) -> int:
    """L1: equal share of a sample among the sources."""
    share = max_samples // n_sources
    if share == 0:
        raise ValueError(f"{max_samples} samples cannot be shared among {n_sources} sources")
    return share


def cap_per_source(
    rows: DataFrame,
    cap: int,
    *,
    min_chars: int = DEFAULT_MIN_CHARS,
    max_chars: int = DEFAULT_MAX_CHARS,
    source: str = "source",
    order: str = "row_id",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """L1: the first ``cap`` rows of every source among those of usable length."""
    block = measured(rows, order, block_rows).block(F.col(order))
    usable = within_length(rows, min_chars, max_chars)
    return take_first(usable, cap, [order], block, [source])


def shuffle_key(order: str = "row_id", seed: int = DEFAULT_SEED) -> Column:
    """A uniform key that depends on the row and the seed, not on the partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(order).cast("string")))


def seeded_shuffle(
    rows: DataFrame, order: str = "row_id", seed: int = DEFAULT_SEED
) -> DataFrame:
    """L2: rows in a random but repeatable order."""
    return rows.orderBy(shuffle_key(order, seed), order)


def take_shuffled(
    rows: DataFrame, n: int, order: str = "row_id", seed: int = DEFAULT_SEED
) -> DataFrame:
    """L2 and L3: the first ``n`` rows of the seeded order, for an ``n`` of any size.

    The shuffle key is uniform, so its leading digits cut the rows into even blocks and
    no row outside the last one is sorted.
    """
    keyed = rows.withColumn("_shuffle", shuffle_key(order, seed))
    taken = take_first(keyed, n, ["_shuffle", order], F.substring("_shuffle", 1, 4))
    return taken.drop("_shuffle")


def concat_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """All parts by column name; an error when every source was skipped."""
    if not parts:
        raise RuntimeError("the mix produced no usable examples")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def load_mix(
    rows: DataFrame,
    entries: DataFrame,
    *,
    max_samples: int | None = None,
    min_chars: int = DEFAULT_MIN_CHARS,
    max_chars: int = DEFAULT_MAX_CHARS,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The mix end to end: rows of the chosen sources, capped, filtered and sampled.

    ``rows`` holds ``row_id, source, text``; ``entries`` is what :func:`resolve_mix`
    returned, with the source in ``key``.
    """
    chosen = entries.select(F.col("key").alias("source"))
    members = rows.join(chosen, "source", "left_semi")
    if max_samples is None:
        return seeded_shuffle(within_length(members, min_chars, max_chars), seed=seed)
    share = per_source_share(max_samples, entries.count())
    # Equal shares add up to no more than max_samples, so no further cap is needed (L3).
    capped = cap_per_source(members, share, min_chars=min_chars, max_chars=max_chars)
    return seeded_shuffle(capped, seed=seed)
