"""Toxicity by the nearest labelled examples: exact weighted TF-IDF cosine, block-max index.

Terms are words (runs of letters, A-Z as a-z). All that an example has are kept; none is cut
off. TF-IDF is multiplied by one plus the log-likelihood ratio of the term's counts in the
classes: about two where they differ by chance, rising with the sample where they do not.
What no example has adds to no cosine and is left out of a text's length. Examples are a
bounded, stratified sample of labelled rows.

The postings of a term go from its largest weight down, in blocks that know their maximum.
For a text, blocks of all its terms are read from the largest possible contribution on.
What the next block of every term could still add, and the length of what is unread, bound
what an example can gain; reading stops once few examples can be among the nearest, and the
cosines of these are computed in full.

The k nearest vote with their cosine, classes weighted back to their true shares; all that
tie for the last votes share these. The votes are calibrated by isotonic regression on the
examples themselves, each left out of its own vote.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.shared import checkpointed, freed, received, send, sliced, text_bytes
from meterloom.llm.shingles import mixed, powers, prefix_hashes

EXAMPLES = 2_000  # of each class, at most
EXAMPLE_BYTES = 1 << 16  # longer texts are scored, but not made examples
NEIGHBOURS = 25
BLOCK = 32
READ_AT_ONCE = 1 << 15  # postings, at first
IN_FULL = 64
TIED = 1e-9
REMEMBERED = 10_000
FILTER_BITS = 20


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = letter[128:] = True
    return lower, letter


_LOWER, _LETTER = _tables()


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every feature occurrence."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    letter = _LETTER[data]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    cuts = ends[(ends > 0) & (ends < n)]
    first[cuts], last[cuts - 1] = letter[cuts], letter[cuts - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(ends, starts, side="right") - 1
    sums, inverse = prefix_hashes(_LOWER[data]), powers(n + 1, True)
    return row, mixed((sums[stops] - sums[starts]) * inverse[starts])


class Known:
    """The kept features: their place in the vocabulary, found through a bit table."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes)
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)

    def counts(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, feature and how often, in the order of rows."""
        row, h = features(data, ends)
        hit = np.flatnonzero(self.maybe[self._slot(h)])
        row, h = row[hit], h[hit]
        at = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        real = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        both, times = np.unique(row[real] * len(self.hashes) + at[real], return_counts=True)
        if not len(self.hashes):
            return both, both, times
        return both // len(self.hashes), both % len(self.hashes), times


@dataclass
class Blocks:
    """Blocks of postings: where those of a term start, where their postings do, and maxima."""

    of: np.ndarray
    starts: np.ndarray
    most: np.ndarray
    examples: np.ndarray
    weights: np.ndarray


@dataclass
class Model:
    """The examples' index, and the steps of the calibration."""

    known: Known
    worth: np.ndarray  # of every feature, in front of its counts
    ids: np.ndarray
    toxic: np.ndarray
    share: np.ndarray  # rows that an example of class 0 or 1 stands for
    prior: float
    firsts: np.ndarray  # where the features of an example start
    features: np.ndarray
    times: np.ndarray
    steps: np.ndarray
    values: np.ndarray
    sent: Broadcast | None = None  # the model without the steps
    blocks: Blocks | None = None

    def __getstate__(self) -> dict:
        """Features and counts travel packed, and without weights and postings."""
        state = vars(self) | {"weights": None, "blocks": None}
        return state | {"features": _packed(np.diff(self.features, prepend=0)), "times": _packed(self.times)}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self.features = np.cumsum(_unpacked(state["features"]), dtype=np.int32)
        self.times = _unpacked(state["times"])

    def vector(self, feature: np.ndarray, times: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(times)) * self.worth[feature]
        return weight / np.sqrt((weight * weight).sum())

    def nearest(
        self, feature: np.ndarray, weight: np.ndarray, k: int, but: int = -1
    ) -> tuple[np.ndarray, np.ndarray]:
        """The examples with the k largest cosines (above 0), and these.

        All that tie with the k-th are returned, so there may be more than k. Blocks are read
        in growing numbers.
        """
        if self.blocks is None:
            self.blocks = self._inverted()
        index = self.blocks
        score = np.zeros(len(self.ids))
        first, last = index.of[feature], index.of[feature + 1]
        block = _places(first, last)
        term = np.repeat(np.arange(len(feature)), last - first)
        impact = index.most[block] * weight[term]
        order = np.argsort(-impact, kind="stable")
        block, term, impact = block[order], term[order], impact[order]
        # What a term can still add once all blocks before this one are read.
        sizes = index.starts[block + 1] - index.starts[block]
        ends = np.cumsum(sizes)
        ahead = np.zeros(len(feature))
        square = weight * weight
        at, goal, lowest = 0, READ_AT_ONCE, 0.0
        while at < len(block):
            to = max(at + 1, int(np.searchsorted(ends, goal, side="right")))
            place = _places(index.starts[block[at:to]], index.starts[block[at:to] + 1])
            terms = index.weights[place] * np.repeat(weight[term[at:to]], sizes[at:to])
            score += np.bincount(index.examples[place], terms, len(score))
            if but >= 0:
                score[but] = 0.0
            at, goal = to, 2 * goal
            lowest = np.partition(score, -k)[-k] if len(score) >= k else 0.0
            if at == len(block):
                break
            ahead[:] = 0.0
            ahead[term[at:][::-1]] = impact[at:][::-1]  # the first that is unread comes last
            unread = min(float(ahead.sum()), float(np.sqrt(square[ahead > 0].sum())))
            # Float32 weights may be longer than 1 by their rounding.
            if lowest > unread:
                best = np.flatnonzero(score + unread > lowest - 1e-6)
                if len(best) <= IN_FULL:
                    near = self.cosines(best, feature, weight)
                    break
        if at >= len(block):
            best = np.flatnonzero((score > 0) & (score >= lowest - TIED))
            near = score[best]
        if but >= 0:
            best, near = best[best != but], near[best != but]
        top = np.lexsort((best, -near))
        if len(top) > k:
            top = top[near[top] >= near[top[k - 1]] - TIED]
        return best[top], near[top]

    def cosines(self, examples: np.ndarray, feature: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of some examples, from all their features."""
        firsts = self.firsts
        place = _places(firsts[examples], firsts[examples + 1])
        of = np.repeat(np.arange(len(examples)), firsts[examples + 1] - firsts[examples])
        dense = np.zeros(len(self.worth))
        dense[feature] = weight
        return np.bincount(of, self.weights[place] * dense[self.features[place]], len(examples))

    def _inverted(self) -> Blocks:
        """Postings by term and falling weight, in blocks of one term each."""
        example = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.firsts))
        weight = (1 + np.log(self.times)) * self.worth[self.features]
        weight /= np.sqrt(np.bincount(example, weight * weight, len(self.ids)))[example]
        self.weights = weight.astype(np.float32)
        order = np.lexsort((-self.weights, self.features))
        counts = np.bincount(self.features, minlength=len(self.worth))
        per_term = -(-counts // BLOCK)
        of = np.concatenate([[0], np.cumsum(per_term)])
        inside = _places(np.zeros(len(counts), np.int64), per_term)
        starts = np.repeat(np.cumsum(counts) - counts, per_term) + inside * BLOCK
        weights = self.weights[order]
        return Blocks(of, np.append(starts, len(order)), weights[starts], example[order], weights)

    def vote(self, best: np.ndarray, near: np.ndarray, k: int = NEIGHBOURS) -> float:
        """The share of toxic rows; all that tie with the k-th share the votes left to them."""
        weight = near * self.share[self.toxic[best]]
        if len(near) > k:
            tied = near <= near[k - 1] + TIED
            weight[tied] *= (k - (~tied).sum()) / tied.sum()
        # The prior has the say of one row: all of it where there is no neighbour.
        return float(
            ((weight * self.toxic[best]).sum() + self.prior) / (weight.sum() + 1.0)
        )

    def calibrated(self, vote: float) -> float:
        at = np.searchsorted(self.steps, vote, side="right") - 1
        return float(self.values[max(at, 0)]) if len(self.values) else vote


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function nearest to the points: where steps start, and their values."""
    places, of = np.unique(x, return_inverse=True)
    whole = np.bincount(of, weight, len(places))
    means = np.bincount(of, weight * y, len(places)) / whole
    steps, values, weights = [], [], []
    for at, value, w in zip(places, means, whole):
        steps.append(at), values.append(value), weights.append(w)
        while len(values) > 1 and values[-2] >= values[-1]:
            w = weights[-2] + weights[-1]
            values[-2] = (values[-2] * weights[-2] + values[-1] * weights[-1]) / w
            weights[-2] = w
            del steps[-1], values[-1], weights[-1]
    return np.array(steps), np.array(values)


def _places(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """All places of some ranges, one range after the other."""
    sizes = stops - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def weigh_features(examples: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all features, in order, and how far they tell the classes apart.

    From ``text`` and ``toxic``; none without examples of both classes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            row, h = features(*text_bytes(batch.column("text")))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((row, h))
            row, h = row[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            found, of = np.unique(h[new], return_inverse=True)
            yes = np.bincount(of, toxic[row[new]], len(found)).astype(np.int64)
            all_of = np.bincount(of, minlength=len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(yes), pa.array(all_of)], ["h", "yes", "n"]
            )

    totals = examples.agg(F.sum("toxic").alias("yes"), F.count(F.lit(1)).alias("n")).first()
    if not totals["yes"] or totals["yes"] == totals["n"]:
        return np.zeros(0, np.uint64), np.zeros(0)
    share = totals["yes"] / totals["n"]
    counts = (
        examples.mapInArrow(freed(run), "h bigint, yes bigint, n bigint")
        .groupBy("h")
        .agg(F.sum("yes").alias("yes"), F.sum("n").alias("n"))
    )

    def term(seen: F.Column, expected: F.Column) -> F.Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    yes, no = F.col("yes").cast("double"), (F.col("n") - F.col("yes")).cast("double")
    surprise = term(yes, F.col("n") * share) + term(no, F.col("n") * (1 - share))
    found = counts.select("h", surprise.alias("surprise")).toPandas()
    h = found["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], 1.0 + np.maximum(found["surprise"].to_numpy()[order], 0.0)


def fit(docs: DataFrame, labels: DataFrame, learn: F.Column) -> Model:
    """A model from the rows of ``labels`` (``id``, ``toxic``) that ``learn`` lets in.

    At most ``EXAMPLES`` rows of each class are examples, those with the smallest hashes of
    their ids; of these, texts of more than ``EXAMPLE_BYTES`` are left out, so what the driver
    gathers is bounded by both. How many features hold for how many documents is counted over all of
    ``docs`` (``id``, ``text``).
    """
    usable = labels.filter(learn & F.col("toxic").isin(0, 1) & F.col("id").isNotNull())
    sizes = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    picked = None
    for kind in (0, 1):
        some = usable.filter(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(EXAMPLES)
        picked = some if picked is None else picked.unionByName(some)
    picked = checkpointed(picked.dropDuplicates(["id"]))
    short = docs.filter(F.octet_length("text") <= EXAMPLE_BYTES)
    examples = checkpointed(short.join(F.broadcast(picked), "id"))
    hashes, surprise = weigh_features(examples)
    known, n = Known(hashes), len(hashes)
    sent = send(docs.sparkSession, known)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = received(sent), np.zeros(n, np.int64)
        for batch in sliced(batches, "text"):
            _, feature, _ = known.counts(*text_bytes(batch.column("text")))
            count += np.bincount(feature, minlength=n)
        found = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count[found])], ["f", "n"])

    total = docs.count()
    holding = np.zeros(n)
    counts = docs.mapInArrow(freed(held), "f bigint, n bigint").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    holding[counts["f"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    worth = np.log1p(total / np.maximum(holding, 1)) * surprise

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = received(sent)
        for batch in sliced(batches, "text"):
            row, feature, times = known.counts(*text_bytes(batch.column("text")))
            cuts = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (feature, times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("toxic"), *lists], ["id", "toxic", "f", "n"]
            )

    kept = (
        examples.mapInArrow(freed(counted), "id bigint, toxic int, f array<int>, n array<int>")
        .orderBy("id")
        .toArrow()
    )
    toxic, ids = (kept.column(x).to_numpy().astype(np.int64) for x in ("toxic", "id"))
    index = _index(n, worth, {x: [r.values.to_numpy() for r in kept.column(x)] for x in ("f", "n")})
    del kept
    used = np.bincount(toxic, minlength=2)
    share = np.array([sizes.get(c, 0) / max(used[c], 1) for c in (0, 1)])
    prior = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    model = Model(known, worth, ids, toxic, share, prior, *index, np.zeros(0), np.zeros(0))
    whole = send(docs.sparkSession, model)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(whole)
        for batch in batches:
            votes = np.full(batch.num_rows, model.prior)
            for at, i in enumerate(batch.column("id").to_numpy()):
                own = slice(model.firsts[i], model.firsts[i + 1])
                if own.start < own.stop:
                    f, n = model.features[own], model.times[own]
                    votes[at] = model.vote(*model.nearest(f, model.vector(f, n), NEIGHBOURS, but=i))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(votes)], ["id", "vote"])

    parts = max(1, min(len(toxic) // 64, 4 * docs.sparkSession.sparkContext.defaultParallelism))
    rows = docs.sparkSession.range(0, len(toxic), 1, parts).mapInArrow(freed(voted), "id bigint, vote double").toPandas()
    votes = np.full(len(toxic), prior)
    votes[rows["id"].to_numpy(np.int64)] = rows["vote"].to_numpy()
    model.sent = whole
    model.steps, model.values = isotonic(votes, toxic.astype(float), share[toxic])
    return model


def _index(n: int, worth: np.ndarray, kept) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the features of every example start, these, and how often each is there."""
    firsts = np.concatenate([[0], np.cumsum([len(f) for f in kept["f"]])]).astype(np.int64)
    both = (np.concatenate([*kept[x], np.zeros(0, np.int32)]).astype(np.int32) for x in ("f", "n"))
    return firsts, *both


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, most of them small: like bytes together, deflated."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


SCORED = "score double, evidence array<struct<id: bigint, cosine: double, toxic: int>>"


def scored(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``evidence`` (the five nearest examples) to every row.

    Null and empty texts, and texts without a known feature, have no neighbour: their score
    is the calibrated share of toxic rows among such. Equal texts have equal scores; an
    empty table stays empty; columns of these names are replaced. Without examples of both
    classes every score is the share of toxic rows in the labels (0 without labels).
    """
    df = df.drop("score", "evidence")
    sent = model.sent or send(df.sparkSession, model)
    steps, values = model.steps, model.values
    kind = pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(sent)
        model.steps, model.values = steps, values
        # Texts with the same features as one before (by a digest) have its neighbours.
        found: dict[bytes, tuple[float, list[dict]]] = {}
        for batch in sliced(batches, text):
            row, feature, times = model.known.counts(*text_bytes(batch.column(text)))
            score = np.full(batch.num_rows, model.calibrated(model.prior))
            shown: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            cuts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else []
            for a, b in zip(cuts, [*cuts[1:], len(row)]):
                f, t = feature[a:b], times[a:b]
                same = hashlib.blake2b(f.tobytes() + t.tobytes(), digest_size=16).digest()
                if same not in found:
                    if len(found) >= REMEMBERED:
                        found.clear()
                    best, near = model.nearest(f, model.vector(f, t), NEIGHBOURS)
                    found[same] = model.calibrated(model.vote(best, near)), [
                        {"id": int(model.ids[e]), "cosine": float(c), "toxic": int(model.toxic[e])}
                        for e, c in zip(best[:5], near[:5])
                    ]
                score[row[a]], shown[row[a]] = found[same]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array(shown, kind)],
                [*batch.schema.names, "score", "evidence"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(freed(run), f"{fields}, {SCORED}")
