"""Ranked lexical search by presence masks.

Documents become an index of the terms that the items ask for: per document its length,
the terms and how often each occurs. A task lays a block of documents out as one row of
counts per term. For an item, the rows of its terms turn into bits; documents with the same
bits share a mask and are one group. The largest count of a term and the shortest document
of the block bound what a mask can score; masks are opened from the largest bound on, and
a block is done when the next bound is under the item's worst kept score. Kept scores are
carried from block to block of a task. Every task hands on its best ``k`` an item, which are
merged in two steps, so that no task sees the lists of all others.

Weights and scores are whole numbers (see ``rank``): equal on every engine and in any order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.shared import received, send, sliced, staged, staged_path

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERMS_AT_ONCE = 1 << 16  # terms of items that one pass over the documents looks for
CELLS = 1 << 23  # counts that a block of documents holds
LARGEST_BLOCK = 4096
MERGED = 256  # tasks whose lists meet in the first step


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms in order, A-Z as a-z, and the row of each."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    words, rows = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(words), 0)
    return words.filter(real), rows.filter(real).to_numpy(zero_copy_only=False)


def _item_terms(items: DataFrame) -> DataFrame:
    """``item`` and each of its distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words, rows = tokens(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(rows)), words], ["item", "term"]
            )

    return items.mapInArrow(run, "item bigint, term string").distinct()


def index(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """``id``, ``n`` (terms in all), ``terms`` (places in ``vocabulary``), ``times``.

    Documents without any term are left out.
    """
    sent = send(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = received(sent)
        for batch in sliced(batches, "text"):
            words, rows = tokens(batch.column("text"))
            n = np.bincount(rows, minlength=batch.num_rows)
            found = pc.index_in(words, value_set=vocabulary)
            hit = pc.is_valid(found)
            place = found.filter(hit).to_numpy(zero_copy_only=False).astype(np.int64)
            row = rows[hit.to_numpy(zero_copy_only=False)].astype(np.int64)
            both, times = np.unique(row * len(vocabulary) + place, return_counts=True)
            row, place = np.divmod(both, max(len(vocabulary), 1))
            cuts = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(cuts, pa.array(x))
                for x in (place.astype(np.int32), times.astype(np.int64))
            ]
            out = pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n), *lists], ["id", "n", "terms", "times"]
            )
            yield out.filter(pa.array(n > 0))

    return docs.mapInArrow(run, "id bigint, n bigint, terms array<int>, times array<bigint>")


def _holding(indexed: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        found = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count[found])], ["term", "n"])

    counts = indexed.select("terms").mapInArrow(run, "term bigint, n bigint")
    rows = counts.groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["term"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


class Best:
    """The best rows of one item so far: largest score first, then smallest id."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = self.ids = np.zeros(0, np.int64)

    @property
    def worst(self) -> int:
        """What a row must reach to be listed (it may tie)."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        real = scores >= self.worst
        scores = np.concatenate([self.scores, scores[real]])
        ids = np.concatenate([self.ids, ids[real]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def groups(present: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents by mask: the bits of each distinct mask, documents in its order, where masks start.

    ``present`` has a row per term and a column per document.
    """
    packed = np.ascontiguousarray(np.packbits(present, axis=0).T)
    wide = np.zeros((packed.shape[0], -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    masks = wide.view(np.uint64)
    order = np.lexsort(masks.T) if masks.shape[1] > 1 else np.argsort(masks[:, 0], kind="stable")
    changed = (masks[order[1:]] != masks[order[:-1]]).any(axis=1)
    starts = np.flatnonzero(np.concatenate([[True], changed]))
    return present[:, order[starts]].T, order, np.append(starts, len(order))


def search_block(
    counts: np.ndarray, weight: np.ndarray, ids: np.ndarray, m: np.ndarray, best: Best
) -> int:
    """Add a block's documents to ``best``; returns how many were scored.

    ``counts``: a row per term of the item, a column per document.
    """
    bits, order, starts = groups(counts > 0)
    most, shortest = counts.max(axis=1).astype(np.int64), int(m.min())
    bounds = bits.astype(np.int64) @ (weight * _worth(most, shortest))
    opened = np.argsort(-bounds, kind="stable")
    at = scored = 0
    while at < len(opened) and bounds[opened[at]] >= max(best.worst, 1):
        # Masks with a like bound together: as many again as were opened before.
        to = max(at + 1, min(2 * at, len(opened)))
        some = [order[starts[g] : starts[g + 1]] for g in opened[at:to] if bounds[g] >= best.worst]
        some = np.concatenate(some)
        scores = (weight[:, None] * _worth(counts[:, some], m[some])).sum(axis=0)
        best.add(scores, ids[some])
        at, scored = to, scored + len(some)
    return scored


def _worth(times: np.ndarray, m) -> np.ndarray:
    """What a term adds for one unit of its weight, in millionths."""
    times = times.astype(np.int64)
    return (1_000_000_000 * times) // (1000 * times + 20 * m)


def _best_of_tasks(
    indexed: DataFrame, items: dict[int, np.ndarray], weight: np.ndarray, total: int, length: int, k: int
) -> DataFrame:
    size = len(weight)
    block = int(min(LARGEST_BLOCK, max(64, CELLS // max(size, 1))))
    sent = send(indexed.sparkSession, (items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = received(sent)
        best = {item: Best(k) for item in items}
        for batch in batches:
            n, ids = (batch.column(c).to_numpy() for c in ("n", "id"))
            m = np.array([50 + 50 * x * total // length for x in n.tolist()], np.int64)
            bounds = batch.column("terms").offsets.to_numpy().astype(np.int64)
            terms = batch.column("terms").values.to_numpy()
            times = batch.column("times").values.to_numpy()
            # Documents of like length together, so that the shortest bounds the others well.
            by_length = np.argsort(n, kind="stable")
            for first in range(0, len(n), block):
                some = by_length[first : first + block]
                sizes = bounds[some + 1] - bounds[some]
                place = np.arange(sizes.sum()) + np.repeat(bounds[some] - np.cumsum(sizes) + sizes, sizes)
                held, of = np.unique(terms[place], return_inverse=True)
                counts = np.zeros((len(held) + 1, len(some)), np.int64)
                counts[of, np.repeat(np.arange(len(some)), sizes)] = times[place]
                where = np.full(size, len(held))
                where[held] = np.arange(len(held))
                for item, asked in items.items():
                    rows = where[asked]
                    here = rows < len(held)
                    if here.any():
                        search_block(counts[rows[here]], weight[asked[here]], ids[some], m[some], best[item])
        task = TaskContext.get().partitionId()
        for item, found in best.items():
            rows = len(found.ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows, task)), pa.array(np.full(rows, item)), pa.array(found.ids), pa.array(found.scores)],
                ["task", "item", "id", "score"],
            )

    return indexed.mapInArrow(run, "task bigint, item bigint, id bigint, score bigint")


def _first(df: DataFrame, k: int, *keys) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank(
    docs: DataFrame, items: DataFrame, doc: str, text: str, item: str, item_text: str, k: int = 50
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII. With N documents
    that have a term, L terms in these, n terms in a document and df documents that hold a
    term: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + 50 n N div L, and a document
    scores the sum of w * (10^9 tf div (1000 tf + 20 m)) over the item's distinct terms.

    Ids are integers; rows without one take no part, but a document without one counts in N,
    L and df. Null and empty texts have no terms: such a document is no document here, such
    an item has no rows. Equal scores go by the smaller id. Repeated documents are ranked one
    by one; rows of ``items`` with one id are one item. Empty tables give no rows. Only the
    named columns are read, so others may have any name.

    Items are searched in blocks of about ``TERMS_AT_ONCE`` terms, each a pass over all
    documents; a block's terms and items are broadcast.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc).cast("bigint").alias("id"), F.col(text).alias("text"))
    items = items.select(F.col(item).cast("bigint").alias("item"), F.col(item_text).alias("text"))
    asked = staged(_item_terms(items.filter("item is not null")), "item_terms")
    passes = max(1, -(-asked.count() // TERMS_AT_ONCE))
    found = staged_path(spark, "ranked")
    for number in range(passes):
        some = asked.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).toArrow()
        terms = pc.unique(some.column("term").combine_chunks())
        place = pc.index_in(some.column("term"), value_set=terms).to_numpy().astype(np.int64)
        of = some.column("item").to_numpy()
        order = np.lexsort((place, of))
        ids, starts = np.unique(of[order], return_index=True)
        wanted = dict(zip(ids.tolist(), np.split(place[order], starts[1:])))
        indexed = staged(index(docs, terms), "terms")
        counted = indexed.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("length")).first()
        total, length = counted["rows"], counted["length"] or 1
        weight = np.array(
            [math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in _holding(indexed, len(terms)).tolist()],
            np.int64,
        )
        best = _best_of_tasks(indexed.filter("id is not null"), wanted, weight, total, length, k)
        first = _first(best, k, "item", F.expr(f"task div {MERGED}")).drop("rank")
        _first(first, k, "item").select(
            F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score"
        ).write.mode("append").parquet(found)
    return spark.read.schema("item_id bigint, rank int, doc_id bigint, score bigint").parquet(found)
