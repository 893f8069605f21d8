"""A character-level bidirectional LSTM with a CRF over its outputs, in numpy.

Both directions run as one stacked product. Characters are looked up, so the input product
is a row of a table. ``train`` minimises the CRF's negative log likelihood with Adam;
``decode`` gives the best path of every window and the posterior of each of its tags.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; first character of a kind, another one of it
OTHER, PAD = 128, 129  # all characters beyond ASCII; what is beyond a text's ends
CHARACTERS = 130
NEVER = -1e4
MARGIN = 0.01  # far more than single precision is off by
BLOCK = 768  # windows whose steps are taken at once: what they need stays in a core's cache
HEAD = 18  # steps after which a run is compared with the next window's over the same characters
SPELLS = (1, 2, 4, 8, 16)  # steps behind these, each spell's gates and cells are summed up
NEAR = 0.03  # how far apart their outputs may be then, and at any step from then on
LEEWAY = NEAR  # by how much outputs that are taken over count as off
FEW = 64  # one window of so many is decoded without a closer look


def characters(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.minimum(points, OTHER).astype(np.int64)


def allowed() -> np.ndarray:
    """Which tag may follow which: a kind goes on only from itself."""
    out = np.ones((TAGS, TAGS), bool)
    for kind in range(len(KINDS)):
        out[:, 2 + 2 * kind] = False
        out[[1 + 2 * kind, 2 + 2 * kind], 2 + 2 * kind] = True
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Tagger:
    def __init__(self, hidden: int = 16, seed: int = 11) -> None:
        random = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {
            "look": random.normal(0, 0.3, (2, CHARACTERS, 4 * hidden)),
            "again": random.normal(0, 1 / np.sqrt(hidden), (2, hidden, 4 * hidden)),
            "bias": np.zeros((2, 1, 4 * hidden)),
            "out": random.normal(0, 0.3, (2 * hidden, TAGS)),
            "tag": np.zeros(TAGS),
            "next": np.zeros((TAGS, TAGS)),
        }
        self.p["bias"][:, :, hidden : 2 * hidden] = 1.0  # remember at first

    def _run(self, x: np.ndarray, keep: bool = True) -> tuple[np.ndarray, tuple]:
        """Tag scores (time, window, tag) of windows of characters, and what the gradient needs."""
        n, steps = x.shape
        size = self.hidden
        both = np.stack([x.T, x.T[::-1]], axis=1)  # time, direction, window
        h, c = (np.zeros((2, n, size)) for _ in range(2))
        kept = []
        outputs = np.zeros((steps, 2, n, size))
        look, again, bias = self.p["look"], self.p["again"], self.p["bias"]
        sides = np.arange(2)[:, None]
        for t in range(steps):
            z = look[sides, both[t]] + h @ again + bias
            gates = _sigmoid(z[:, :, : 3 * size])
            i, f, o = (gates[:, :, k * size : (k + 1) * size] for k in range(3))
            g = np.tanh(z[:, :, 3 * size :])
            before = (h, c)
            c = f * c + i * g
            bent = np.tanh(c)
            h = o * bent
            if keep:
                kept.append((before, i, f, o, g, bent))
            outputs[t] = h
        joined = np.concatenate([outputs[:, 0], outputs[::-1, 1]], axis=2)
        return joined @ self.p["out"] + self.p["tag"], (both, kept, joined)

    def _next(self) -> np.ndarray:
        return np.where(allowed(), self.p["next"], NEVER)

    def _first(self) -> np.ndarray:
        """A window starts as if a character outside came before it."""
        return self._next()[0]

    def _sums(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sums over paths up to each place and from it on, scaled; log sum over all paths.

        The product of the first two is a tag's posterior. The last result times the first of
        the place before, and the factor of the transition, is that of a pair of tags.
        """
        top = scores.max(axis=2)
        here, after = np.exp(scores - top[:, :, None]), np.exp(self._next())
        a, b = np.zeros_like(scores), np.ones_like(scores)
        scale = np.zeros(top.shape)
        now = here[0] * after[0]
        for t in range(len(scores)):
            if t:
                now = (a[t - 1] @ after) * here[t]
            scale[t] = np.maximum(now.sum(1), 1e-300)
            a[t] = now / scale[t][:, None]
        rest = np.zeros_like(scores)
        for t in range(len(scores) - 1, -1, -1):
            rest[t] = here[t] * b[t] / scale[t][:, None]
            if t:
                b[t - 1] = rest[t] @ after.T
        return a, b, np.log(scale).sum(0) + top.sum(0), rest

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags ``y``, and its gradient."""
        scores, (both, kept, joined) = self._run(x)
        n, steps = x.shape
        after, y = self._next(), y.T
        a, b, total, rest = self._sums(scores)
        at = np.arange(n)
        path = scores[np.arange(steps)[:, None], at, y].sum(0) + self._first()[y[0]]
        path += after[y[:-1], y[1:]].sum(0)
        d = a * b
        pairs = np.exp(after) * (a[:-1].reshape(-1, TAGS).T @ rest[1:].reshape(-1, TAGS))
        pairs[0] += d[0].sum(0)
        np.add.at(pairs, (np.zeros(n, int), y[0]), -1.0)
        np.add.at(pairs, (y[:-1].ravel(), y[1:].ravel()), -1.0)
        d[np.arange(steps)[:, None], at, y] -= 1.0
        grad = {
            "next": np.where(allowed(), pairs, 0.0),
            "tag": d.sum((0, 1)),
            "out": joined.reshape(-1, joined.shape[2]).T @ d.reshape(-1, TAGS),
        }
        back = d @ self.p["out"].T
        size = self.hidden
        back = np.stack([back[:, :, :size], back[::-1, :, size:]], axis=1)
        grad |= {k: np.zeros_like(self.p[k]) for k in ("look", "again")}
        dh, dc = (np.zeros((2, n, size)) for _ in range(2))
        changes = np.zeros((2, steps, n, 4 * size))
        again = self.p["again"].transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            (h, c), i, f, o, g, bent = kept[t]
            dh = dh + back[t]
            dc = dc + dh * o * (1 - bent * bent)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * c * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - g * g)],
                axis=2,
            )
            grad["again"] += h.transpose(0, 2, 1) @ dz
            changes[:, t] = dz
            dh, dc = dz @ again, dc * f
        grad["bias"] = changes.sum((1, 2))[:, None]
        for side in (0, 1):
            one = both[:, side].reshape(-1, 1) == np.arange(CHARACTERS)
            grad["look"][side] = one.astype(float).T @ changes[side].reshape(-1, 4 * size)
        return float((total - path).mean()), {k: v / n for k, v in grad.items()}

    def train(
        self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.02, seed: int = 5
    ) -> float:
        """Adam over shuffled batches, with a rate that falls to a tenth; returns the last loss."""
        random = np.random.default_rng(seed)
        mean, square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        rounds = max(1, epochs * -(-len(x) // batch))
        step, last = 0, 0.0
        for _ in range(epochs):
            order = random.permutation(len(x))
            for first in range(0, len(x), batch):
                some = order[first : first + batch]
                last, grad = self.loss(x[some], y[some])
                length = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                now = rate * (1 - 0.9 * step / rounds)
                step += 1
                for k, g in grad.items():
                    g = g * min(1.0, 5.0 / max(length, 1e-12))
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    fair = np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                    self.p[k] -= now * mean[k] / (1 - 0.9**step) / fair
        return last

    def _light(self, x: np.ndarray) -> np.ndarray:
        """The scores of :meth:`_run` in single precision, as (time, tag, window).

        Sigmoids are made of exp, which numpy runs on whole vectors where it has no such tanh.
        """
        p = {k: v.astype(np.float32) for k, v in self.p.items()}
        n, steps = x.shape
        size = self.hidden
        rows, again = (p["look"] + p["bias"]).reshape(-1, 4 * size), p["again"]
        for weights in (rows, again):  # a sigmoid is 1 / (1 + exp(-z)), a tanh 2 / (1 + exp(-2 z)) - 1
            weights[..., : 3 * size] *= -1
            weights[..., 3 * size :] *= -2
        places = np.stack([x.T, x.T[::-1] + CHARACTERS], axis=1)
        h, c = (np.zeros((2, n, size), np.float32) for _ in range(2))
        z, step = (np.empty((2, n, 4 * size), np.float32) for _ in range(2))
        g, bent = (np.empty_like(c) for _ in range(2))
        outputs = np.empty((steps, 2, n, size), np.float32)
        with np.errstate(over="ignore"):  # 1 / (1 + inf) is the 0 that is wanted
            for t in range(steps):
                np.take(rows, places[t], axis=0, out=z, mode="clip")
                z += np.matmul(h, again, out=step)
                np.exp(z, out=z)
                z += 1
                np.divide(1, z, out=z)
                np.multiply(z[:, :, 3 * size :], 2, out=g)
                g -= 1
                g *= z[:, :, :size]
                c *= z[:, :, size : 2 * size]
                c += g
                np.multiply(c, -2, out=bent)
                np.exp(bent, out=bent)
                bent += 1
                np.divide(2, bent, out=bent)
                bent -= 1
                h = np.multiply(z[:, :, 2 * size : 3 * size], bent, out=outputs[t])
        sides = outputs.transpose(0, 1, 3, 2)
        scores = p["out"][:size].T @ sides[:, 0]
        scores += p["out"][size:].T @ sides[::-1, 1]
        scores += p["tag"][:, None]
        return scores

    def _gates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights in single precision, gate by gate, and those of tags over the one outside.

        A sigmoid of z is (1 + tanh(z / 2)) / 2; what :meth:`_advance` calls h is twice that.
        """
        size = self.hidden
        look = (self.p["look"] + self.p["bias"]).reshape(2 * CHARACTERS, 4, size).transpose(1, 0, 2).copy()
        again = self.p["again"].reshape(2, size, 4, size).transpose(2, 0, 1, 3) / 2
        look[:3] /= 2
        again[:3] /= 2
        out = (self.p["out"][:, 1:] - self.p["out"][:, :1]).reshape(2, size, TAGS - 1).transpose(0, 2, 1) / 2
        return tuple(np.ascontiguousarray(w, np.float32) for w in (look, again, out))

    def _advance(
        self,
        weights: tuple[np.ndarray, np.ndarray, np.ndarray],
        places: np.ndarray,
        h: np.ndarray,
        c: np.ndarray,
        gains: np.ndarray,
        seen: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
    ) -> np.ndarray | None:
        """Take ``h`` and ``c`` on, in place, over the characters ``places`` (time, direction, window).

        ``gains`` (time, direction, tag, window) gets what each direction adds to the tags.
        ``seen`` gets the least and the largest tanh of each cell, and what is left of its third
        array after all steps; what is left after the first one is returned then.
        """
        look, again, out = weights
        z, step = (np.empty((4, *h.shape), np.float32) for _ in range(2))
        (i, f, o, g), gates, across = z, z[:3], h.transpose(0, 2, 1)
        bent, first = np.empty_like(c), None
        pairs = list(zip(look, step))
        for t, here in enumerate(places):
            for table, part in pairs:
                table.take(here, 0, part, "clip")
            np.matmul(h, again, out=z)
            z += step
            np.tanh(z, out=z)
            gates += 1
            c *= f
            g *= i
            c += g
            c *= 0.5
            np.tanh(c, out=bent)
            np.multiply(bent, o, out=h)
            np.matmul(out, across, out=gains[t])
            if seen:
                least, most, left = seen
                np.minimum(least, bent, out=least)
                np.maximum(most, bent, out=most)
                left *= f
                if first is None:
                    first = left * 0.5
        if seen:
            left *= 0.5 ** len(places)
        return first

    def _gains(self, x: np.ndarray) -> tuple[np.ndarray, int]:
        """Bounds of what outputs add to tags over the one outside, as (time from each end on,
        direction, tag, window); steps run.

        Windows have an even length. Where a window's second half is the next one's first half,
        both forward runs go over it, one of them from a fresh state; backward it is the other
        way round. ``HEAD`` steps on, the outputs of the two mostly agree. With the same gates
        from then on, cells that differ never differ by more, nor change sides. Their tanh
        differ by that at most, by no more than the fresh run's ever lacked to 1, or -1, on that
        side, and by no more than its slope and what is left of the difference allow. Where no
        output may differ by over ``NEAR`` at any step, the fresh run's gains are taken for both,
        raised by what outputs that are off by ``LEEWAY`` make of them; elsewhere the run goes on.
        That the gates are the same holds but for what outputs within ``NEAR`` change in them;
        this is not bounded, and measured to be far below the raise.
        """
        n, steps = x.shape
        half = steps // 2
        head = min(HEAD, half)
        joint = half + head
        cuts = [*[head + s for s in (0, *SPELLS) if head + s < half], half]
        weights = self._gates()
        places = np.empty((steps, 2, n), np.intp)
        places[:, 0] = x.T
        np.add(x.T[::-1], CHARACTERS, out=places[:, 1], dtype=np.intp)
        gains = np.empty((steps, 2, TAGS - 1, n), np.float32)
        h, c, fresh_h, fresh_c, slope = (np.zeros((2, n, self.hidden), np.float32) for _ in range(5))
        least, most = np.ones_like(h), -np.ones_like(h)
        for first in range(0, n, BLOCK):
            some = np.s_[:, first : first + BLOCK]
            now, cells = h[some], c[some]
            its, into = places[:, some[0], some[1]], gains[..., some[1]]
            self._advance(weights, its[:head], now, cells, into[:head])
            fresh_h[some], fresh_c[some] = now, cells
            left = np.ones_like(cells)
            for a, b in zip(cuts, cuts[1:]):
                low, high = np.ones_like(cells), -np.ones_like(cells)
                first_left = self._advance(weights, its[a:b], now, cells, into[a:b], (low, high, left))
                flat = np.maximum(np.maximum(low, -high), 0)
                np.maximum(slope[some], first_left * (1 - flat * flat), out=slope[some])
                np.minimum(least[some], low, out=least[some])
                np.maximum(most[some], high, out=most[some])
            self._advance(weights, its[half:joint], now, cells, into[half:joint])
        same = (x[:-1, half:] == x[1:, :half]).all(axis=1)
        alone = []
        for side, (mine, other) in enumerate([(np.s_[:-1], np.s_[1:]), (np.s_[1:], np.s_[:-1])]):
            apart = c[side, mine] - fresh_c[side, other]
            room = np.where(apart > 0, 1 - least[side, other], 1 + most[side, other])
            outward = np.where(apart > 0, least[side, other] >= 0, most[side, other] <= 0)
            apart = np.abs(apart)
            # A slope grows by exp(2 d) at most on the way towards zero; 1 less a square is rounded.
            steep = (slope[side, other] + 1e-6) * np.where(outward, 1, np.exp(np.minimum(2 * apart, 80)))
            apart = np.minimum(apart * np.where(steep < 1, steep, 1), room)
            np.maximum(apart, np.abs(h[side, mine] - fresh_h[side, other]) / 2, out=apart)
            near = apart.max(axis=1) <= NEAR
            off = 2 * LEEWAY * np.abs(weights[2][side]).sum(axis=1)
            np.add(gains[head:half, side, :, other], off[:, None], out=gains[joint:, side, :, mine])
            taken = np.zeros(n, bool)
            taken[mine] = near & same
            alone.append(np.flatnonzero(~taken))
        longest = max(map(len, alone))
        if longest:
            rows, sides = np.zeros((2, longest), np.intp), np.arange(2)[:, None]
            for side, some in enumerate(alone):
                rows[side, : len(some)] = some
            rest = np.empty((steps - joint, 2, TAGS - 1, longest), np.float32)
            self._advance(weights, places[joint:, sides, rows], h[sides, rows], c[sides, rows], rest)
            for side, some in enumerate(alone):
                gains[joint:, side, :, some] = rest[:, side, :, : len(some)].transpose(2, 0, 1)
        return gains, 2 * n * joint + (steps - joint) * sum(map(len, alone))

    def quiet(self, x: np.ndarray) -> np.ndarray:
        """Windows whose best path is outside all along, told by a cheap run in single precision.

        A path gains over that one what its runs of characters inside gain, each from the tag
        before it to the tag after it. Bounds of that, over all kinds at once, tell most
        windows; where they leave more than a few, these are looked at closer. Where no run
        gains anything there is no span, as far as the bounds of :meth:`_gains` hold; other
        windows may still have none.
        """
        gains, _ = self._gains(x)
        start, other, on, still, leave = self._turns()
        enter = np.stack([other, np.maximum(on, still)], axis=1).reshape(-1, 1)
        enter += (self.p["tag"][1:] - self.p["tag"][0]).astype(np.float32)[:, None]
        worth, best = (np.full(len(x), NEVER, np.float32) for _ in range(2))
        for t in range(len(gains)):
            gain = gains[t, 0] + gains[-1 - t, 1]
            gain += enter
            worth += gain.max(axis=0)
            np.maximum(worth, (gain[::2] + (start - other)).max(axis=0), out=worth)
            np.maximum(best, worth, out=best)
        quiet = np.maximum(best + leave.max(), worth) < -MARGIN
        loud = np.flatnonzero(~quiet)
        if len(loud) * FEW > len(x):
            quiet[loud] = self._outside(x[loud])
        return quiet

    def _turns(self) -> tuple[np.ndarray, ...]:
        """What transitions gain, by kind: to its first tag from outside and at best from another
        kind, to further ones from the first and from themselves; by tag: to the outside."""
        after = (self._next() - self.p["next"][0, 0]).astype(np.float32)
        first, more = np.arange(1, TAGS, 2), np.arange(2, TAGS, 2)
        turns = after[0, first], after[1:, first].max(0), after[first, more], after[more, more], after[1:, 0]
        return tuple(turn[:, None] for turn in turns)

    def _outside(self, x: np.ndarray) -> np.ndarray:
        """:meth:`quiet` by whole runs over every window.

        The best run is found tag by tag: a kind begins with its first tag and goes on from
        itself. Only where a kind follows another one at once does the best of all stand for
        the tag before.
        """
        scores = self._light(x.astype(np.intp))
        gain = scores[:, 1:] - scores[:, :1]
        start, other, on, still, leave = self._turns()
        worth = np.full((TAGS - 1, len(x)), NEVER, np.float32)  # of a run that ends here, by tag
        best = np.full(len(x), NEVER, np.float32)
        for t in range(len(gain)):
            fresh = np.maximum(worth.max(0) + other, start)
            longer = np.maximum(worth[::2] + on, worth[1::2] + still)
            worth[::2], worth[1::2] = fresh, longer
            worth += gain[t]
            np.maximum(best, (worth + leave).max(0), out=best)
        return np.maximum(best, worth.max(0)) < -MARGIN

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags of every window, and the posterior of each."""
        scores, _ = self._run(x, keep=False)
        a, b, _, _ = self._sums(scores)
        posterior = a * b
        after = self._next()
        best = scores[0] + self._first()
        came = np.zeros(scores.shape, np.int8)
        for t in range(1, len(scores)):
            through = best[:, :, None] + after
            came[t] = through.argmax(1)
            best = scores[t] + through.max(1)
        tags = np.zeros(x.T.shape, np.int64)
        tags[-1] = best.argmax(1)
        at = np.arange(len(x))
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = came[t][at, tags[t]]
        sure = posterior[np.arange(len(scores))[:, None], at, tags]
        return tags.T, sure.T
