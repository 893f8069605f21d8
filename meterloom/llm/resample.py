"""Target-distribution importance resampling over hashed word features.

A pre-tokeniser of the tokenizers library, a Split by a pattern with nothing trained, cuts
ASCII-lowered texts into words with their offsets. Windows of consecutive offset pairs are
features; their CRCs fill a histogram of buckets for the corpus and one for the target. The
logarithm of the two shares of a bucket is its gain. A document's weight is the mean gain of
its features; with Gumbel noise added, the largest sums are a draw without replacement in
proportion to the weights.

Texts are tokenised once: bucket counts are kept as a table that both the histogram and the
sums read. The drawn rows are numbered by a sort over ranges and the sizes of these.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import PreTokenizedString, Regex
from tokenizers.pre_tokenizers import Split

from meterloom.llm.shared import received, send, sliced, staged

WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
SEPARATOR = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]")
PIECE = 4096
REMEMBERED = 1 << 18


def pieces(text: str) -> Iterator[str]:
    """A text in parts, each of which but the first starts at a separator."""
    first = 0
    while first < len(text):
        cut = SEPARATOR.search(text, first + PIECE) if len(text) - first > PIECE else None
        last = cut.start() if cut else len(text)
        yield text[first:last]
        first = last


def words(lowered: bytes, splitter: Split) -> list[tuple[int, int]]:
    """Where the words of an ASCII-lowered text start and end, in bytes."""
    out: list[tuple[int, int]] = []
    before = 0
    for part in pieces(lowered.decode()):
        cut = PreTokenizedString(part)
        splitter.pre_tokenize(cut)
        pairs = [s[1] for s in cut.get_splits("original", "byte")]
        out.extend([(before + a, before + b) for a, b in pairs] if before else pairs)
        before += len(part.encode())
    return out


class Buckets(dict):
    """The bytes of a feature to its bucket; forgets all when it has grown too large."""

    def __init__(self, count: int) -> None:
        super().__init__()
        self.count = count

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.count
        return bucket


def counted(df: DataFrame, buckets: int, longest: int = 1) -> DataFrame:
    """``id``, ``n_words``, ``n_features``, ``bucket`` and ``times`` (arrays) of ``id``, ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, known = Split(Regex(WORD), "removed", invert=True), Buckets(buckets)
        for batch in sliced(batches, "text"):
            n, sizes, found, times = [], [], [], []
            for text in batch.column("text").to_pylist():
                raw = (text or "").encode().lower()  # lowers A-Z alone
                pairs = words(raw, splitter)
                n.append(len(pairs))
                of = [known[raw[a:b]] for a, b in pairs]
                for size in range(2, longest + 1):
                    for window in zip(*(pairs[i:] for i in range(size))):
                        of.append(known[b" ".join([raw[a:b] for a, b in window])])
                sizes.append(len(of))
                places, often = np.unique(np.array(of, np.int32), return_counts=True)
                found.append(places)
                times.append(often)
            cuts = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(x).astype(kind)))
                for x, kind in ((found, np.int32), (times, np.int64))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(sizes, pa.int64()), *lists],
                ["id", "n_words", "n_features", "bucket", "times"],
            )

    kind = df.schema["id"].dataType.simpleString()
    return df.select("id", "text").mapInArrow(
        run, f"id {kind}, n_words bigint, n_features bigint, bucket array<int>, times array<bigint>"
    )


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows; counts are combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column("bucket").flatten().to_numpy(), batch.column("times").flatten().to_numpy())
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    parts = features.select("bucket", "times").mapInArrow(run, "bucket bigint, n bigint")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of a bucket's share in the target over that in the corpus."""
    buckets = len(corpus)
    all_of, wanted = int(corpus.sum()) + buckets, int(target.sum()) + buckets
    return np.array(
        [
            math.floor(1000 * math.log(((t + 1) * float(all_of)) / ((s + 1) * float(wanted))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``weight``: the floored mean gain of a row's features, 0 without any."""
    sent = send(features.sparkSession, gain)
    kind = features.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = received(sent)
        for batch in batches:
            worth = gain[batch.column("bucket").flatten().to_numpy()] * batch.column("times").flatten().to_numpy()
            cuts = batch.column("bucket").offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(worth)])
            cuts = cuts - (cuts[0] if len(cuts) else 0)
            n = batch.column("n_features").to_numpy()
            mean = (sums[cuts[1:]] - sums[cuts[:-1]]) // np.maximum(n, 1)
            kept = [batch.column(c) for c in ("id", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(mean.astype(np.int64))], ["id", "n_words", "n_features", "weight"]
            )

    return features.mapInArrow(run, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(seed: int) -> F.Column:
    """Floored thousandfold Gumbel noise of ``id``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("bigint")


def numbered(df: DataFrame, eligible: F.Column, most: int) -> DataFrame:
    """Add ``rank``, from 1 by falling ``score``, then rising ``id``, to the ``most`` first.

    Other rows get null. Scores are whole numbers over a range that does not grow with the
    rows, so their counts name the score of the last row drawn; what is not below it is
    sorted over ranges and numbered from the ranges' sizes. The third key tells repeated
    rows apart, so that no range holds more than its share.
    """
    counts = df.filter(eligible).groupBy("score").count().toPandas().sort_values("score")[::-1]
    reached = np.cumsum(counts["count"].to_numpy(np.int64))
    if most < 1 or not len(reached):
        return df.withColumn("rank", F.lit(None).cast("bigint"))
    last = int(counts["score"].to_numpy()[np.searchsorted(reached, most)])
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("_twin")]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    ranged = (
        df.filter(eligible & (F.col("score") >= last))
        .withColumn("_twin", at)
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(*df.columns, at.alias("_at"))
    )
    ranged = staged(ranged, "drawn")
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("part")).agg((F.max("_at").bitwiseAND((1 << 33) - 1) + 1).alias("n"))
    before, rows = 0, []
    for size in sorted(sizes.collect()):
        rows.append((size["part"], before))
        before += size["n"]
    starts = df.sparkSession.createDataFrame(rows, "_part bigint, _before bigint")
    rank = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    placed = ranged.join(F.broadcast(starts), part == F.col("_part")).select(
        *df.columns, F.when(rank <= most, rank).alias("rank")
    )
    rest = df.filter(~eligible | (F.col("score") < last))
    return placed.unionByName(rest.withColumn("rank", F.lit(None).cast("bigint")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    identity: str,
    text: str,
    target_text: str,
    buckets: int = 10_000,
    longest: int = 1,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """Every row's ``id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn).

    Of the rows with ``least_words`` words, ``percent`` in a hundred (rounded down) are drawn:
    those with the largest scores, equal ones by the smaller id.

    Null and empty texts have no features and weight 0; a null id draws the noise of an empty
    name and is last among equals. Repeated rows are scored and drawn one by one, with ranks
    of their own. Empty tables: no documents, no rows; no target, every bucket is equally
    wanted. Only the named columns are read, so others may have any name.
    """
    docs = docs.select(F.col(identity).alias("id"), F.col(text).alias("text"))
    features = staged(counted(docs, buckets, longest), "features")
    wanted = target.select(F.lit(0).alias("id"), F.col(target_text).alias("text"))
    gain = gains(histogram(features, buckets), histogram(counted(wanted, buckets, longest), buckets))
    scored = staged(
        weighed(features, gain).withColumn("score", F.col("weight") + noise(seed)), "weighed"
    )
    eligible = F.col("n_words") >= least_words
    most = percent * scored.filter(eligible).count() // 100
    columns = ["id", "n_features", "weight", "score", "rank"]
    return numbered(scored, eligible, most).select(*columns)
