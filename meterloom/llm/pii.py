"""Personal data in texts: fixed patterns, and what a character tagger adds to them.

The patterns label the tagger's examples: windows around digits and at signs, some with
their spans rewritten as people hide them (an at sign spelt out, a phone number without its
plus). The tagger, a bidirectional LSTM with a CRF, reads overlapping windows of whole
texts, every one: an address that is spelt out needs neither a digit nor an at sign. A
cheaper run of the same network tells the windows without a span; the others are read in
full. Spans that a window's
edge cuts are joined with what the next window saw of them; of all a text's candidates
those that do not overlap and have the largest sum of posteriors stay. What overlaps a
pattern's span is not added, nor what fails the checks of its kind
(Luhn, parts up to 255, the number of digits).
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.shared import received, send, sliced
from meterloom.llm.tagger import KINDS, PAD, Tagger, characters

WINDOW, STRIDE = 128, 64
EXAMPLES = 400  # windows of each kind, and as many without a span
EPOCHS = 5
AT_ONCE = 3072  # windows
DECODED_AT_ONCE = 512  # windows
READ_AT_ONCE = 16 << 20  # bytes of texts
SURE = 0.95

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From every at sign to both sides: in time that is linear for any text."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = max(at + 1, done)


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time of every chain of numbers with dots between."""
    for chain in _DOTTED.finditer(text):
        parts = [(chain.start() + p.start(), chain.start() + p.end()) for p in _PART.finditer(chain.group())]
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            small = (text[a:b].lstrip("0") for a, b in four)
            if all(len(p) < 3 or (len(p) == 3 and int(p) <= 255) for p in small):
                yield four[0][0], four[3][1]


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in found.group()) <= 15:
            yield found.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of what the patterns find, in order."""
    found = (emails, ips, cards, phones)
    return sorted((a, kind, b) for kind, of in enumerate(found) for a, b in of(text))


def plausible(text: str, kind: int) -> bool:
    """The checks that the patterns' spans pass, on the letters and digits of a span alone."""
    numbers = _PART.findall(text)
    digits = "".join(numbers)
    if kind == 0:
        return len(re.findall(r"[A-Za-z0-9]+", text)) > 2
    if kind == 1:
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def window_starts(text: str) -> list[int]:
    """Where windows start that hold a digit or an at sign.

    Windows start at multiples of the stride, so that each character but the first and last
    ones is in two; the last window reaches the end.
    """
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    starts: list[int] = []
    hit = _TRIGGER.search(text)
    while hit:
        at = hit.start()
        low = max(0, (at - WINDOW) // STRIDE + 1) * STRIDE
        high = min(at // STRIDE * STRIDE, last)
        for start in range(min(low, last), high + 1, STRIDE):
            if not starts or start > starts[-1]:
                starts.append(start)
        # All windows that hold this character are listed; on to the next stride.
        hit = _TRIGGER.search(text, (at // STRIDE + 1) * STRIDE)
    return starts


def every_start(text: str) -> range:
    """Where all windows of a text start."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    return range(0, last + 1 if text else 0, STRIDE)


def every_window(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All windows of some texts, ``AT_ONCE`` at a time: their text, start and characters."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n = 0
    for at, text in enumerate(texts):
        starts = np.arange(0, every_start(text).stop, STRIDE)
        for first in range(0, len(starts), AT_ONCE):
            some = starts[first : first + AT_ONCE]
            part = characters(text[some[0] : some[-1] + WINDOW])
            padded = np.full(some[-1] + WINDOW - some[0], PAD, np.uint8)
            padded[: len(part)] = part
            windows = np.ndarray((len(some), WINDOW), np.uint8, padded, strides=(STRIDE, 1))
            held.append((np.full(len(some), at), some, windows))
            n += len(some)
            if n >= AT_ONCE:
                owners, places, x = (np.concatenate(each) for each in zip(*held))
                yield owners[:AT_ONCE], places[:AT_ONCE], x[:AT_ONCE]
                held, n = [(owners[AT_ONCE:], places[AT_ONCE:], x[AT_ONCE:])], n - AT_ONCE
    if n:
        yield tuple(np.concatenate(each) for each in zip(*held))


def cut(text: str) -> np.ndarray:
    """The characters of a window."""
    out = np.full(WINDOW, PAD)
    part = characters(text[:WINDOW])
    out[: len(part)] = part
    return out


def tag_spans(tags: np.ndarray, sure: np.ndarray, start: int) -> list[tuple[int, int, int, float]]:
    """Start, end, kind and sum of posteriors of a window's spans."""
    out = []
    at = 0
    places = np.flatnonzero(tags)
    while at < len(places):
        first = places[at]
        inside = tags[first] + tags[first] % 2  # the tag of the kind's further characters
        last = first + 1
        while last < len(tags) and tags[last] == inside:
            last += 1
        out.append((start + int(first), start + int(last), int(inside) // 2 - 1, float(sure[first:last].sum())))
        at = int(np.searchsorted(places, last))
    return out


def reconciled(
    windows: list[tuple[int, list[tuple[int, int, int, float]]]], base: list[tuple[int, int, int]], text: str
) -> list[tuple[int, int, int, float]]:
    """The spans that a text's windows agree on: start, kind, end and mean posterior."""
    whole: dict[tuple[int, int, int], float] = {}
    parts: list[tuple[int, int, int, float]] = []
    for start, spans in windows:
        for a, b, kind, worth in spans:
            if (a == start and start > 0) or (b == start + WINDOW and b < len(text)):
                parts.append((kind, a, b, worth))
            else:
                whole[a, b, kind] = max(worth, whole.get((a, b, kind), 0.0))
    # Spans that an edge cuts go on in the next window: joined with all of their kind they meet.
    if parts:
        pool = sorted(parts + [(k, a, b, w) for (a, b, k), w in whole.items()])
        kind, a, b, worth = pool[0]
        for k, c, d, w in [*pool[1:], (-1, 0, 0, 0.0)]:
            if k == kind and c <= b:
                shared = max(0, min(b, d) - c)
                worth += w * (1 - shared / max(d - c, 1))
                b = max(b, d)
            else:
                whole[a, b, kind] = max(worth, whole.get((a, b, kind), 0.0))
                kind, a, b, worth = k, c, d, w
    taken = sorted(base)
    reach = np.maximum.accumulate([s[2] for s in taken]).tolist() if taken else []
    starts = [s[0] for s in taken]

    def free(a: int, b: int) -> bool:
        before = bisect_right(starts, b - 1)
        return before == 0 or reach[before - 1] <= a

    spans = sorted(
        (b, a, kind, worth)
        for (a, b, kind), worth in whole.items()
        if worth >= SURE * (b - a) and free(a, b) and plausible(text[a:b], kind)
    )
    # The disjoint spans with the largest sum, by the usual recurrence over ends.
    ends = [s[0] for s in spans]
    best, choice = [0.0], []
    for at, (b, a, kind, worth) in enumerate(spans):
        before = bisect_right(ends, a, 0, at)
        choice.append(best[before] + worth > best[at])
        best.append(max(best[at], best[before] + worth))
    out, at = [], len(spans)
    while at:
        if choice[at - 1]:
            b, a, kind, worth = spans[at - 1]
            out.append((a, kind, b, min(1.0, worth / (b - a))))
            at = bisect_right(ends, a, 0, at - 1)
        else:
            at -= 1
    return sorted(out)


def hidden(text: str, kind: int, form: int) -> str:
    """A span as people write it to keep it from patterns."""
    if kind == 0:
        return text.replace("@", ("(at)", "[at]", " @ ")[form % 3])
    if kind == 3:
        return (text.lstrip("+"), text[text.find("(") :] if "(" in text else text[1:])[form % 2]
    if kind == 2:
        bare = text.replace(" ", "").replace("-", "")
        return (".", "/", "_")[form % 3].join(bare[i : i + 4] for i in range(0, len(bare), 4))
    return text.replace(".", ("[.]", " . ", "(.)")[form % 3])


def example(text: str, spans: list[tuple[int, int, int]], form: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tags of a window; ``form`` 0 to 2 hides its spans, others leave them."""
    pieces, tags, at = [], [], 0
    for a, kind, b in spans:
        if a < at:
            continue
        pieces.append(text[at:a])
        tags.extend([0] * (a - at))
        written = hidden(text[a:b], kind, form) if form < 3 else text[a:b]
        pieces.append(written)
        tags.extend([1 + 2 * kind] + [2 + 2 * kind] * (len(written) - 1) if written else [])
        at = b
    pieces.append(text[at:])
    tags.extend([0] * (len(text) - at))
    y = np.zeros(WINDOW, np.int64)
    y[: len(tags[:WINDOW])] = tags[:WINDOW]
    return cut("".join(pieces)), y


def _marked(batch: pa.RecordBatch, text: str) -> np.ndarray:
    """Rows with a digit, an at sign or a plus; the others hold no span."""
    found = pc.match_substring_regex(batch.column(text), "[0-9@+]")
    return np.flatnonzero(found.fill_null(False).to_numpy(zero_copy_only=False))


def examples(docs: DataFrame, text: str) -> DataFrame:
    """``kind`` (4: no span) and ``text`` of the windows to learn from: at most ``EXAMPLES`` a kind.

    Distinct windows in the order of a checksum, cut down within each task, in groups of
    tasks, and over all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[dict[str, int]] = [{} for _ in range(len(KINDS) + 1)]
        for batch in sliced(batches, text):
            column = batch.column(text)
            for row in _marked(batch, text).tolist():
                whole = column[row].as_py()
                spans = base_spans(whole)
                for start in window_starts(whole):
                    part = whole[start : start + WINDOW]
                    kinds = {k for a, k, b in spans if a < start + WINDOW and b > start}
                    if any(a < start + WINDOW < b or a < start < b for a, k, b in spans):
                        continue  # a cut span is no example of anything
                    for kind in kinds or {len(KINDS)}:
                        best[kind][part] = zlib.crc32(part.encode())
                for kind, some in enumerate(best):
                    if len(some) > 4 * EXAMPLES:
                        best[kind] = dict(sorted(some.items(), key=lambda x: (x[1], x[0]))[:EXAMPLES])
        task = TaskContext.get().partitionId()
        for kind, some in enumerate(best):
            rows = sorted(some.items(), key=lambda x: (x[1], x[0]))[:EXAMPLES]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task] * len(rows), pa.int32()),
                    pa.array([kind] * len(rows), pa.int32()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[0] for r in rows], pa.string()),
                ],
                ["task", "kind", "mark", "text"],
            )

    found = docs.select(text).mapInArrow(run, "task int, kind int, mark bigint, text string")
    for keys in ([F.expr("task div 256"), "kind"], ["kind"]):
        found = found.groupBy(*keys, "mark", "text").agg(F.min("task").alias("task")).select(
            "task", "kind", "mark", "text"
        )
        order = Window.partitionBy(*keys).orderBy("mark", "text")
        found = found.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= EXAMPLES).drop("at")
    return found.select("kind", "text")


@dataclass
class Model:
    tagger: Tagger | None  # none where the patterns found nothing to learn from


def fit(docs: DataFrame, text: str) -> Model:
    """A tagger from the windows of ``examples``, at most ``5 * EXAMPLES`` short texts."""
    rows = sorted(set((r["text"], r["kind"]) for r in examples(docs, text).collect()))
    if not any(kind < len(KINDS) for _, kind in rows):
        return Model(None)
    seen, x, y = set(), [], []
    for part, _ in rows:
        if part in seen:
            continue
        seen.add(part)
        spans = base_spans(part)
        for form in {9, zlib.crc32(part.encode()) % 6} if spans else {9}:
            a, b = example(part, spans, form)
            x.append(a)
            y.append(b)
    tagger = Tagger()
    tagger.train(np.stack(x), np.stack(y), EPOCHS)
    return Model(tagger)


_SPAN = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sure", pa.float64())]


def find(df: DataFrame, text: str, model: Model) -> DataFrame:
    """Add ``base`` (what the patterns find) and ``spans`` (these, and what the tagger adds).

    Both are arrays of kind, start, end and sure (the mean posterior; 1 for patterns), ordered
    by start, then kind as listed in ``KINDS``; offsets count characters, the end excluded.
    The text column itself is not returned. Null and empty texts have empty arrays; repeated
    rows are treated alike, each by itself; an empty table stays empty; columns called
    ``base`` or ``spans`` are replaced. No column may be needed twice: the text column must
    have another name than these.
    """
    df = df.drop(*[c for c in ("base", "spans") if c != text])
    others = [c for c in df.columns if c != text]
    sent = send(df.sparkSession, model)
    kind_of = pa.list_(pa.struct(_SPAN))

    def shown(spans: list[tuple[int, int, int, float]]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b, "sure": s} for a, k, b, s in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = received(sent).tagger
        for batch in sliced(batches, text, READ_AT_ONCE):
            base: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            every = list(base)
            texts = [t or "" for t in batch.column(text).to_pylist()]
            marked = set(_marked(batch, text).tolist())
            found = [base_spans(t) if row in marked else [] for row, t in enumerate(texts)]
            more = added(tagger, texts, found) if tagger else [[] for _ in texts]
            for row, (spans, others_of) in enumerate(zip(found, more)):
                sure = [(a, k, b, 1.0) for a, k, b in spans]
                base[row], every[row] = shown(sure), shown(sorted(sure + others_of))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(base, kind_of), pa.array(every, kind_of)],
                [*others, "base", "spans"],
            )

    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in others)
    span = "array<struct<kind: string, start: bigint, end: bigint, sure: double>>"
    return df.mapInArrow(run, f"{fields}base {span}, spans {span}")


def added(
    tagger: Tagger, texts: list[str], bases: list[list[tuple[int, int, int]]]
) -> list[list[tuple[int, int, int, float]]]:
    """What the tagger adds to the patterns' spans of some texts, whose windows it reads together."""
    def read(some: list[tuple[int, int]]) -> np.ndarray:
        return np.stack([cut(texts[o][s : s + WINDOW]) for o, s in some])

    loud: list[tuple[int, int]] = []
    for owners, starts, x in every_window(texts):
        hit = ~tagger.quiet(x)
        loud += zip(owners[hit].tolist(), starts[hit].tolist())
    windows: list[list[tuple[int, list]]] = [[] for _ in texts]
    for first in range(0, len(loud), DECODED_AT_ONCE):
        some = loud[first : first + DECODED_AT_ONCE]
        tags, sure = tagger.decode(read(some))
        for (o, s), t, p in zip(some, tags, sure):
            windows[o].append((s, tag_spans(t, p, s)))
    return [reconciled(w, b, t) for w, b, t in zip(windows, bases, texts)]


def joined_spans(column: str) -> F.Column:
    """``kind:start:end`` of every span, with commas between."""
    shown = F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))
    return F.array_join(shown, ",")
