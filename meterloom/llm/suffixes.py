"""Removal of long repeats by a logarithmic family of sparse suffix arrays.

The suffixes that are indexed start where the content says (:mod:`meterloom.llm.runs`), so
each string of 100 bytes is represented once, and about 3 suffixes in 100 bytes are kept.
They are ordered by hash of their first bytes, then of all that they represent: any order
that puts equal beginnings side by side serves to find matches, and this one spreads evenly
over the shards of the index, one shard a task.

A shard is a family of sorted arrays. Every batch that arrives is sorted, merge-scanned
against each array there is, and becomes one itself; arrays of like size are merged, so an
entry is moved a logarithmic number of times. A scan finds entries that represent the same
strings (the later occurrence is a repeat as a whole) and, at the end, equal beginnings of
different strings. Those are cut into cells of eight strings, and what still is not alone
into single strings, by the same family each time.

What is common is thinned before it is shuffled: of equal entries in a slice of rows one is
sent on, and a beginning with many continuations in a slice is sent on as a mark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.runs import WIDTH, runs_of, substring_hashes
from meterloom.llm.shared import freed, sliced, staged, text_bytes, with_columns
from meterloom.llm.shingles import mixed, powers, prefix_hashes

CELL = 8
MANY = 16
# What a task looks at together: bytes of texts, and entries made of them.
SLICE = 1 << 20
PIECE = 1 << 17
ENTRIES = "key bigint, whole bigint, id bigint, first bigint, last bigint, kind int"
FOUND = "id bigint, first bigint, last bigint, kind int"
ENTRY, MARK, REPEAT, OPEN = 0, 1, 2, 3
_NAMES = ("key", "whole", "id", "first", "last")

Entries = dict[str, np.ndarray]


def _take(entries: Entries, rows: np.ndarray) -> Entries:
    return {n: a[rows] for n, a in entries.items()}


def _ordered(entries: Entries) -> tuple[Entries, Entries]:
    """Entries in order, the first occurrence of each (key, whole); and the other ones."""
    order = np.lexsort(
        (entries["first"], entries["id"], entries["whole"], entries["key"])
    )
    entries = _take(entries, order)
    same = np.zeros(len(order), bool)
    same[1:] = (entries["key"][1:] == entries["key"][:-1]) & (
        entries["whole"][1:] == entries["whole"][:-1]
    )
    # The same place again is a row that comes twice, not a repeat.
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    other = same & (
        (entries["id"] != entries["id"][head]) | (entries["first"] != entries["first"][head])
    )
    return _take(entries, ~same), _take(entries, other)


class Family:
    """The sorted arrays of a shard, from the largest to the newest."""

    def __init__(self) -> None:
        self.arrays: list[Entries] = []

    def add(self, batch: Entries) -> Iterator[Entries]:
        """Take a batch in; the repeats that it shows are returned."""
        new, repeats = _ordered(batch)
        yield repeats
        for old in self.arrays:
            mine, theirs = _matches(new, old)
            if not len(mine):
                continue
            later = (old["id"][theirs] > new["id"][mine]) | (
                (old["id"][theirs] == new["id"][mine]) & (old["first"][theirs] > new["first"][mine])
            )
            twice = (old["id"][theirs] == new["id"][mine]) & (
                old["first"][theirs] == new["first"][mine]
            )
            yield _take(old, theirs[later])
            yield _take(new, mine[~later & ~twice])
            for n in ("id", "first", "last"):
                old[n][theirs[later]] = new[n][mine[later]]
            keep = np.ones(len(new["key"]), bool)
            keep[mine] = False
            new = _take(new, keep)
        self.arrays.append(new)
        while len(self.arrays) > 1 and 2 * len(self.arrays[-1]["key"]) > len(self.arrays[-2]["key"]):
            self._merge()

    def _merge(self) -> None:
        b, a = self.arrays.pop(), self.arrays.pop()
        self.arrays.append(_ordered({n: np.concatenate([a[n], b[n]]) for n in _NAMES})[0])

    def open_entries(self) -> Entries:
        """Entries whose key has another continuation, or a mark."""
        while len(self.arrays) > 1:
            self._merge()
        if not self.arrays:
            return {n: np.zeros(0, np.int64) for n in _NAMES}
        all_of = self.arrays[0]
        same = all_of["key"][1:] == all_of["key"][:-1]
        shared = np.zeros(len(all_of["key"]), bool)
        shared[1:] |= same
        shared[:-1] |= same
        return _take(all_of, shared & (all_of["first"] >= 0))


def _matches(new: Entries, old: Entries) -> tuple[np.ndarray, np.ndarray]:
    """Places in both arrays of the entries that agree in key and whole."""
    n = len(old["key"])
    at = np.searchsorted(old["key"], new["key"])
    row = np.flatnonzero(at < n)
    mine, theirs = [], []
    while len(row):
        place = at[row]
        go = (place < n)
        row, place = row[go], place[go]
        same_key = old["key"][place] == new["key"][row]
        row, place = row[same_key], place[same_key]
        hit = old["whole"][place] == new["whole"][row]
        mine.append(row[hit])
        theirs.append(place[hit])
        on = old["whole"][place] < new["whole"][row]
        row = row[on]
        at[row] += 1
    if not mine:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(mine), np.concatenate(theirs)


def _found(entries: Entries, kind: int) -> pa.RecordBatch:
    n = len(entries["id"])
    return pa.RecordBatch.from_arrays(
        [pa.array(entries[c]) for c in ("id", "first", "last")] + [pa.array(np.full(n, kind, np.int32))],
        ["id", "first", "last", "kind"],
    )


def _joined(repeats: Entries) -> Entries:
    """Repeats of one slice, those that touch made one."""
    order = np.lexsort((repeats["first"], repeats["id"]))
    id_, first, last = (repeats[n][order] for n in ("id", "first", "last"))
    if not len(id_):
        return repeats
    new = np.ones(len(id_), bool)
    new[1:] = (id_[1:] != id_[:-1]) | (first[1:] > last[:-1] + 1)
    starts = np.flatnonzero(new)
    return {"id": id_[starts], "first": first[starts], "last": np.maximum.reduceat(last, starts)}


def thinned(entries: Entries) -> pa.RecordBatch:
    """The entries of a slice as rows to be shuffled: entries, marks, repeats and open ones."""
    heads, repeats = _ordered(entries)
    repeats = _joined(repeats)
    starts = np.flatnonzero(np.concatenate([[True], heads["key"][1:] != heads["key"][:-1]])) if len(
        heads["key"]) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate([starts, [len(heads["key"])]]))
    many = np.repeat(sizes >= MANY, sizes)
    marks = heads["key"][starts[sizes >= MANY]] if len(starts) else np.zeros(0, np.int64)
    usual, common = _take(heads, ~many), _take(heads, many)
    parts = [
        {**usual, "kind": np.full(len(usual["key"]), ENTRY)},
        {
            "key": marks, "whole": np.full(len(marks), np.iinfo(np.int64).min), "id": np.full(len(marks), -1),
            "first": np.full(len(marks), -1), "last": np.full(len(marks), -1),
            "kind": np.full(len(marks), MARK),
        },
        # These only pass by: spread by where they are.
        {**common, "key": _spread(common), "kind": np.full(len(common["key"]), OPEN)},
        {**repeats, "key": _spread(repeats), "whole": np.zeros(len(repeats["id"]), np.int64),
         "kind": np.full(len(repeats["id"]), REPEAT)},
    ]
    names = [*_NAMES, "kind"]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([p[n] for p in parts]).astype(np.int32 if n == "kind" else np.int64))
            for n in names
        ],
        names,
    )


def _spread(entries: Entries) -> np.ndarray:
    place = entries["id"] * np.int64(1_000_003) + entries["first"]
    return mixed(place.view(np.uint64)).view(np.int64)


def resolved(entries: DataFrame) -> DataFrame:
    """Rows of :func:`thinned` to ``FOUND``: repeats, and what has to be looked at more closely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family()
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            rows = {n: batch.column(n).to_numpy() for n in _NAMES}
            for passing in (REPEAT, OPEN):
                if (kind == passing).any():
                    yield _found(_take(rows, kind == passing), passing)
            for repeats in family.add(_take(rows, kind <= MARK)):
                repeats = _take(repeats, repeats["first"] >= 0)
                if len(repeats["id"]):
                    yield _found(repeats, REPEAT)
        left = family.open_entries()
        for at in range(0, len(left["key"]), PIECE):
            yield _found(_take(left, slice(at, at + PIECE)), OPEN)

    return entries.repartition("key").mapInArrow(freed(run), FOUND)


def _run_entries(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            data, ends = text_bytes(batch.column("text"))
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            runs, _ = runs_of(data, ends)
            base = ends[:-1][runs.row]
            yield thinned(
                {
                    "key": runs.gram.view(np.int64), "whole": runs.whole.view(np.int64),
                    "id": ids[runs.row].astype(np.int64), "first": runs.first - base,
                    "last": runs.last - base,
                }
            )

    return docs.mapInArrow(freed(run), ENTRIES)


def _closer_entries(docs: DataFrame, still: DataFrame, width: int) -> DataFrame:
    """Cells of ``width`` strings of the runs in ``still``: their key is what all share."""
    # A written table: Spark knows its size, and sends it to the texts if that is small.
    spans = staged(
        still.groupBy("id").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "open"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            data, ends = text_bytes(batch.column("text"))
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column("spans")
            if not len(data):
                continue
            bounds = lists.offsets.to_numpy()
            flat = lists.values
            lo, hi = bounds[0], bounds[-1]
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            first = flat.field("first").to_numpy()[lo:hi] + ends[:-1][row]
            last = flat.field("last").to_numpy()[lo:hi] + ends[:-1][row]
            sums, others = prefix_hashes(data), other_hashes(data)
            # Cells are counted from the k-gram that the strings share, not from the text.
            at = _represented_by(data, sums, first) if width > 1 else first
            for some in _pieces((last - first) // width + 2):
                begin, end, of, key = _cells(sums, at[some], first[some], last[some], width)
                whole = substring_hashes(others, begin, end + WIDTH)
                base, names = ends[:-1][row[some][of]], ids[row[some][of]]
                yield thinned(
                    {
                        "key": key.view(np.int64), "whole": whole.view(np.int64), "id": names,
                        "first": begin - base, "last": end - base,
                    }
                )

    return docs.join(spans, "id").select("id", "text", "spans").mapInArrow(freed(run), ENTRIES)


def _pieces(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of items of about ``PIECE`` in all, one item at least."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PIECE, side="right")))
        yield slice(at, to)
        at = to


def _cells(
    sums: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of the strings of every cell, the span it is of, and its key."""
    if width == 1:
        counts = last - first + 1
        of = np.repeat(np.arange(len(first)), counts)
        begin = first[of] + _steps(counts)
        return begin, begin, of, substring_hashes(sums, begin, begin + WIDTH)
    low, high = at - last, at - first
    cells = high // width - low // width + 1
    of = np.repeat(np.arange(len(first)), cells)
    cell = np.repeat(low // width, cells) + _steps(cells)
    far = np.minimum(cell * width + width - 1, high[of])
    near = np.maximum(cell * width, low[of])
    core = at[of] - cell * width
    key = mixed(substring_hashes(sums, core, core + WIDTH - width + 1) + cell.astype(np.uint64))
    return at[of] - far, at[of] - near, of, key


# A number for every byte, for a hash that does not collide where that of the keys does.
_NUMBERS = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)


def other_hashes(data: np.ndarray) -> np.ndarray:
    """As :func:`prefix_hashes`, with unrelated numbers in place of the bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_NUMBERS[data] * powers(len(data)), out=out[1:])
    return out


def _steps(counts: np.ndarray) -> np.ndarray:
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _represented_by(data: np.ndarray, sums: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the k-gram starts that represents the string at each ``first``."""
    from meterloom.llm.runs import _owners

    return _owners(sums, len(data), powers(len(data) + 1, True))[first]


def repeated_spans(df: DataFrame, identity: str, text: str = "text") -> DataFrame:
    """``id`` and ``spans``: the byte ranges [from, to) of every document to be removed.

    A byte is removed if a string of 100 bytes that covers it also starts earlier: in a
    document with a smaller id, or before it in the same one. Documents without any are
    left out, as are null texts and texts under 100 bytes.
    """
    docs = df.select(F.col(identity).cast("bigint").alias("id"), F.col(text).alias("text")).filter(
        "id is not null and octet_length(text) > 0"
    )
    found = staged(resolved(_run_entries(docs)), "runs")
    repeats = found.filter(F.col("kind") == REPEAT)
    for width in (CELL, 1):
        still = found.filter(F.col("kind") == OPEN)
        found = staged(resolved(_closer_entries(docs, still, width)), f"cells{width}")
        repeats = repeats.unionByName(found.filter(F.col("kind") == REPEAT))
    gathered = repeats.groupBy("id").agg(F.collect_list(F.struct("first", "last")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        for batch in batches:
            out = []
            for spans in batch.column("spans"):
                values = spans.values
                first = values.field("first").to_numpy()[:]
                stop = values.field("last").to_numpy() + WIDTH
                order = np.argsort(first, kind="stable")
                first, stop = first[order], np.maximum.accumulate(stop[order])
                new = np.ones(len(first), bool)
                new[1:] = first[1:] > stop[:-1]
                starts = np.flatnonzero(new)
                stops = np.concatenate([stop[starts[1:] - 1], stop[-1:]])
                out.append(
                    [{"from": a, "to": b} for a, b in zip(first[starts].tolist(), stops.tolist())]
                )
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, kind)], ["id", "spans"])

    return staged(
        gathered.mapInArrow(freed(run), "id bigint, spans array<struct<from: bigint, to: bigint>>"), "spans"
    )


def without_repeats(
    df: DataFrame, identity: str, text: str = "text", whole_characters: bool = False
) -> DataFrame:
    """Add ``n_removed``, ``spans`` (what was taken out) and ``kept`` (the bytes left, binary).

    With ``whole_characters`` a span gives up the bytes at its ends that are only a part of
    a UTF-8 character. Rows that repeat an id are one document and lose the same spans;
    their texts have to be equal. A row with a null id is compared with nothing and keeps
    its text. A null text is empty. An empty table stays
    empty; columns of these names are replaced.
    """
    df = df.drop("spans", "kept", "n_removed", "_id")
    spans = repeated_spans(df, identity, text).filter("id is not null")
    joined = df.join(
        spans.withColumnRenamed("id", "_id"), F.col(identity).cast("bigint") == F.col("_id"), "left"
    ).drop("_id")
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            data, ends = text_bytes(batch.column(text))
            inner = (data & 0xC0) == 0x80
            kept, removed, taken = [], [], []
            for a, b, spans in zip(ends[:-1].tolist(), ends[1:].tolist(), batch.column("spans")):
                at, parts, out = a, [], []
                for span in spans.as_py() or ():
                    start, stop = a + span["from"], a + span["to"]
                    while whole_characters and start < stop and inner[start]:
                        start += 1
                    while whole_characters and start < stop < b and inner[stop]:
                        stop -= 1
                    if start < stop:
                        parts.append(data[at:start].tobytes())
                        out.append({"from": start - a, "to": stop - a})
                        at = stop
                kept.append(b"".join([*parts, data[at:b].tobytes()]))
                removed.append(b - a - len(kept[-1]))
                taken.append(out)
            yield with_columns(
                batch,
                n_removed=pa.array(removed, pa.int64()),
                spans=pa.array(taken, kind),
                kept=pa.array(kept, pa.binary()),
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return joined.mapInArrow(
        freed(run),
        f"{fields}, n_removed bigint, spans array<struct<from: bigint, to: bigint>>, kept binary",
    )
