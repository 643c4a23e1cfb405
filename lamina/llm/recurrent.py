"""A gated recurrent unit with a class-factored output softmax, in numpy.

``z = sigmoid(Pz[x] + h U)``, ``g = tanh(Pg[x] + (z * h) G)`` and ``h' = (1 - z) * h + z * g``: the minimal gated unit,
whose one gate says both what of the state the candidate sees and how much of it is replaced. Gate and candidate
read the word and the state. Output:
``P(word | h) = softmax(h W + b)[class] * softmax(h E + log share)[word among the words of its class]``. Words without
a vector have a fixed share of their class, which the caller adds.

Many sequences are computed side by side, as a step of one alone is a few small products.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np

HIDDEN = 16
#: States that are kept at a time, about, and sequences side by side, at most.
STATES, LANES = 1 << 14, 256
#: States whose classes are worked out at a time: their logits stay in a core's cache.
BLOCK = 1 << 11
#: Rows that move alone do so by this much more: no momentum carries them on through windows in which they don't occur.
ALONE = 3
#: Words' vectors are learned from nothing, and move so much faster.
VECTORS = 8
#: Logits within these bounds have safe exponents in 32 bits.
SAFE = 60.0


def _reach(weights: np.ndarray, more: np.ndarray) -> bool:
    """Whether no state gives a logit beyond ``SAFE``: all numbers of a state lie between -1 and 1."""
    return _below(np.abs(weights).sum(0) + np.abs(more))


def _below(most: np.ndarray) -> bool:
    return float(most.max(initial=0)) < SAFE


def _powers(logits: np.ndarray, safe: bool) -> None:
    """The exponents in place of the logits, which are moved by the row's greatest one unless they are known to be ``safe``."""
    if not safe:
        logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)


def _chosen(logits: np.ndarray, at: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The logit at a place of each row, the exponents (in place of the logits) and their sum; all moved by the
    row's greatest logit unless they are known to be ``safe``."""
    if not safe:
        logits -= logits.max(1, keepdims=True)
    own = logits.ravel().take(_flat(logits, at))
    _powers(logits, True)
    return own, logits, logits @ np.ones(logits.shape[1], logits.dtype)


def _flat(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where a place of each row stands in the rows one after the other."""
    return np.arange(0, logits.size, logits.shape[1]) + at


def _errors(logits: np.ndarray, flat: np.ndarray, safe: bool, part: np.float32, ones: np.ndarray) -> np.ndarray:
    """``part`` of the gradient of minus the logarithm of a softmax at the places ``flat`` (one of each row), in place of
    the logits, but for a factor of each row, which is returned as a column."""
    _powers(logits, safe)
    total = logits @ ones
    logits.reshape(-1)[flat] -= total
    return np.divide(part, total)[:, None]


def _with_one(h: np.ndarray) -> np.ndarray:
    """States with a one, so that a product adds what doesn't depend on them."""
    out = np.ones((len(h), h.shape[1] + 1), h.dtype)
    out[:, :-1] = h
    return out


def _sums(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that occur, ascending, and the sum of ``rows`` (an even number of 32-bit columns) for each."""
    order = np.argsort(at.astype(np.uint16) if at.max(initial=0) < 1 << 16 else at, kind="stable")
    sorted_at = at[order]
    begins = np.flatnonzero(np.diff(sorted_at, prepend=-1))
    # numbers are added in pairs, as complex ones: the same sums in half the time
    return sorted_at[begins], np.add.reduceat(rows.take(order, axis=0).view(np.complex64), begins, axis=0).view(np.float32)


class Cell:
    """The unit over many sequences, a step after the other, with the weights as they are when it is made: halves of
    ``p`` and of the sums of the gate, whose logistic function is a tanh of half of them, stand by themselves."""

    def __init__(self, p: dict, wide: int):
        self.gate, self.candidate = p["p"][:, :HIDDEN] * np.float32(0.5), np.ascontiguousarray(p["p"][:, HIDDEN:])
        self.u, self.g, self.seen = p["u"] * np.float32(0.5), p["g"], np.empty((wide, HIDDEN), np.float32)

    def inputs(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What words add to the gate and the candidate."""
        return self.gate.take(words, axis=0), self.candidate.take(words, axis=0)

    def step(self, to_gate: np.ndarray, to_candidate: np.ndarray, h: np.ndarray, z: np.ndarray, g: np.ndarray, new: np.ndarray) -> None:
        """The gate, the candidate and the new state, written to ``z``, ``g`` and ``new``, from ``inputs`` and the states."""
        seen = self.seen[: len(h)]
        np.matmul(h, self.u, out=z)
        z += to_gate
        np.tanh(z, out=z)
        z += 1
        z *= 0.5
        np.multiply(z, h, out=seen)
        np.matmul(seen, self.g, out=g)
        g += to_candidate
        np.tanh(g, out=g)
        np.subtract(g, h, out=seen)
        seen *= z
        np.add(h, seen, out=new)


class Network:
    """Weights, training and scoring. ``low`` and ``high`` have the places of each class's own words; ``share`` is the
    natural logarithm of each place's share of its class."""

    def __init__(self, symbols: int, low: np.ndarray, high: np.ndarray, share: np.ndarray, seed: int = 1):
        rng, h = np.random.default_rng(seed), HIDDEN
        self.low, self.high, self.share = low, high, share.astype(np.float32)
        first = np.concatenate([rng.normal(0, 0.1, (symbols, h)) - 1.0, rng.normal(0, 0.3, (symbols, h))], axis=1)
        self.p = {
            "p": first, "u": rng.normal(0, 0.1, (h, h)), "g": rng.normal(0, 0.1, (h, h)),
            "w": rng.normal(0, 0.1, (h, len(low))), "b": np.zeros(len(low)), "e": np.zeros((len(share), h)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def moments(self) -> dict:
        return {k: [np.zeros_like(v), np.zeros_like(v), 0] for k, v in self.p.items()}

    def _update(self, moments: dict, grads: dict, rate: float) -> None:
        """Adam. A gradient is an array, or rows and their gradients: then only these rows move."""
        for k, grad in grads.items():
            rows, grad, pace = (*grad, rate * ALONE) if isinstance(grad, tuple) else (None, grad, rate * VECTORS if k == "e" else rate)
            m, v, step = moments[k]
            moments[k][2] = step = step + 1
            first, second = (m, v) if rows is None else (m.take(rows, axis=0), v.take(rows, axis=0))
            change = grad * np.float32(0.1)
            first *= np.float32(0.9)
            first += change
            np.multiply(grad, grad, out=change)
            change *= np.float32(0.01)
            second *= np.float32(0.99)
            second += change
            np.multiply(second, np.float32(1 / (1 - 0.99**step)), out=change)
            np.sqrt(change, out=change)
            change += np.float32(1e-8)
            np.divide(first, change, out=change)
            change *= np.float32(pace / (1 - 0.9**step))
            if rows is None:
                self.p[k] -= change
            else:
                m[rows], v[rows] = first, second
                self.p[k][rows] -= change

    def _classes(self, h: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_chosen`` of the classes."""
        return _chosen(_with_one(h) @ np.vstack([self.p["w"], self.p["b"]]), classes, _reach(self.p["w"], self.p["b"]))

    def _by_class(self, classes: np.ndarray, places: np.ndarray, cells: int) -> tuple[np.ndarray, list[tuple[int, int, slice]]]:
        """Positions in ``places`` of words in classes with several own words, class by class, and for each part of at most
        some ``cells`` logits where its class begins and ends and where in these positions it stands."""
        own = np.flatnonzero((places >= 0) & (self.high[classes] - self.low[classes] > 1))
        own = own[np.argsort(classes[own].astype(np.uint16), kind="stable")]
        parts: list[tuple[int, int, slice]] = []
        begin = 0
        for c, n in enumerate(np.bincount(classes[own]).tolist()):
            low, high = int(self.low[c]), int(self.high[c])
            rows = max(1, cells // max(1, high - low))
            parts += [(low, high, slice(k, min(begin + n, k + rows))) for k in range(begin, begin + n, rows)]
            begin += n
        return own, parts

    def _vectors(self, last: np.ndarray | float) -> np.ndarray:
        """Words' vectors with a last column."""
        out = np.empty((len(self.share), HIDDEN + 1), np.float32)
        out[:, :HIDDEN], out[:, HIDDEN] = self.p["e"], last
        return out

    def _safe_words(self) -> Callable[[int, int], bool]:
        """``_reach`` of the words from one place to another."""
        most = np.abs(self.p["e"]) @ np.ones(HIDDEN, np.float32) + np.abs(self.share)
        if _below(most):
            return lambda low, high: True
        return lambda low, high: _below(most[low:high])

    def _words(self, h: np.ndarray, classes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in ``places`` of words in classes with several own words, their logits, and the sums that ``_chosen`` has for them."""
        own, parts = self._by_class(classes, places, 1 << 17)
        states, targets = _with_one(h.take(own, axis=0)), places[own]
        vectors, safe, logits, totals = self._vectors(self.share), self._safe_words(), *np.empty((2, len(own)), np.float32)
        for low, high, part in parts:
            logits[part], _, totals[part] = _chosen(states[part] @ vectors[low:high].T, targets[part] - low, safe(low, high))
        return own, logits, totals

    def log_probs(self, h: np.ndarray, classes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """log P(class) and, where a place is given (not -1), + log P(its word in the class) in each state."""
        out = np.empty(len(h))
        for k in range(0, len(h), BLOCK):
            part = slice(k, k + BLOCK)
            own, _, total = self._classes(h[part], classes[part])
            out[part] = own - np.log(total)
        at, own, total = self._words(h, classes, places)
        out[at] += own - np.log(total)
        return out

    def train(self, reads: np.ndarray, classes: np.ndarray, places: np.ndarray, starts: np.ndarray, epochs: int = 2, streams: int = 64, steps: int = 16, rate: float = 0.01) -> None:
        moments = self.moments()
        for e in range(epochs):
            self.learn(reads, classes, places, starts, moments, rate * (1 - 0.9 * e / epochs), streams, steps)

    def learn(self, reads: np.ndarray, classes: np.ndarray, places: np.ndarray, starts: np.ndarray, moments: dict, rate: float, streams: int = 64, steps: int = 16) -> None:
        """Truncated backpropagation, once through the words: ``streams`` parts of them side by side, ``steps`` at a
        time; each window starts from the state that the one before it left, and learns classes and the words in them. ``moments`` are those of the steps before."""
        streams = max(1, min(streams, len(reads)))
        length = -(-len(reads) // streams)
        # the last stream ends with the last word, so that none is left out
        cells = np.arange(length)[:, None] + np.arange(streams) * (len(reads) - length) // max(1, streams - 1)
        state = np.zeros((streams, HIDDEN), np.float32)
        for at in range(0, length, steps):
            now = cells[at : at + steps]
            state = self._window(reads[now], classes[now].ravel(), places[now].ravel(), 1 - starts[now].astype(np.float32)[:, :, None], state, moments, rate)

    def _window(self, s: np.ndarray, classes: np.ndarray, places: np.ndarray, goes: np.ndarray, state: np.ndarray, moments: dict, rate: float, words: bool = True) -> np.ndarray:
        n, streams = s.shape
        cell, u, ug = Cell(self.p, streams), self.p["u"], self.p["g"]
        before, h, z, g = (np.empty((n, streams, HIDDEN), np.float32) for _ in range(4))
        to_gate, to_candidate = cell.inputs(s)
        fresh = (goes != 1).any(axis=(1, 2))
        for t in range(n):
            if fresh[t]:
                np.multiply(state, goes[t], out=before[t])
            else:
                before[t] = state
            cell.step(to_gate[t], to_candidate[t], before[t], z[t], g[t], h[t])
            state = h[t]
        # states whose words have vectors stand first, class by class
        own, parts = self._by_class(classes, places, 1 << 18) if words else (np.zeros(0, np.int64), [])
        others = np.ones(n * streams, bool)
        others[own] = False
        order = np.concatenate([own, np.flatnonzero(others)])
        size, part = len(order), np.float32(1 / len(order))
        states, classes, dh = _with_one(h.reshape(-1, HIDDEN).take(order, axis=0)), classes[order], np.empty((size, HIDDEN), np.float32)
        columns, back, safe = np.vstack([self.p["w"], self.p["b"]]), np.ascontiguousarray(self.p["w"].T), _reach(self.p["w"], self.p["b"])
        by_state, ones = np.zeros(columns.shape[::-1], np.float32), np.ones(max(len(back), len(self.share)), np.float32)
        for k in range(0, size, BLOCK):
            rows = slice(k, k + BLOCK)
            d = states[rows] @ columns
            factor = _errors(d, _flat(d, classes[rows]), safe, part, ones[: len(back)])
            np.matmul(d, back, out=dh[rows])
            dh[rows] *= factor
            by_state += d.T @ (states[rows] * factor)
        grads = {"w": by_state[:, :-1].T, "b": by_state[:, -1]}
        if words:
            e, grads["e"] = self.p["e"], np.zeros_like(self.p["e"])
            vectors, safe, targets, more = self._vectors(self.share), self._safe_words(), places[own], np.empty((len(own), HIDDEN), np.float32)
            for low, high, rows in parts:
                d = states[rows] @ vectors[low:high].T
                factor = _errors(d, _flat(d, targets[rows] - low), safe(low, high), part, ones[: high - low])
                np.matmul(d, e[low:high], out=more[rows])
                more[rows] *= factor
                grads["e"][low:high] += d.T @ (states[rows, :HIDDEN] * factor)
            dh[: len(own)] += more
        there = np.empty(size, np.int64)
        there[order] = np.arange(size)
        dh = dh.take(there, axis=0)
        dh = dh.reshape(n, streams, HIDDEN)
        stays = 1 - z
        seen, slope_z = z * before, z * stays
        # how the gate's sum moves with the state and with what the candidate sees, and the candidate's with the state
        gate_by_seen = before * slope_z
        gate_by_state = g - before
        gate_by_state *= slope_z
        slope_g = np.multiply(g, g, out=slope_z)
        np.subtract(1, slope_g, out=slope_g)
        slope_g *= z
        # what reaches the gate and the candidate
        both, ut, gt = np.empty((n, streams, 2 * HIDDEN), np.float32), u.T.copy(), ug.T.copy()
        dz, dg = both[:, :, :HIDDEN], both[:, :, HIDDEN:]
        carry, dseen, more = (np.zeros((streams, HIDDEN), np.float32) for _ in range(3))
        for t in range(n - 1, -1, -1):
            carry += dh[t]
            np.multiply(carry, slope_g[t], out=dg[t])
            np.matmul(dg[t], gt, out=dseen)
            np.multiply(carry, gate_by_state[t], out=dz[t])
            np.multiply(dseen, gate_by_seen[t], out=more)
            dz[t] += more
            carry *= stays[t]
            dseen *= z[t]
            carry += dseen
            np.matmul(dz[t], ut, out=more)
            carry += more
            if fresh[t]:
                carry *= goes[t]
        both = both.reshape(size, 2 * HIDDEN)
        grads["u"] = before.reshape(-1, HIDDEN).T @ both[:, :HIDDEN]
        grads["g"] = seen.reshape(-1, HIDDEN).T @ both[:, HIDDEN:]
        grads["p"] = _sums(both, s.ravel())
        self._update(moments, grads, rate)
        return state

    def score(self, docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], carried: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The sum of ``log_probs`` over each of ``docs`` (what is read, and the class and place that follow), and
        the state after the last one. The first one goes on from the state ``carried``, all others from zero.

        Sequences are dealt to lanes of about the same length, longest first, and the lanes are computed side by
        side in windows: memory follows the windows, whatever the length of a sequence.
        """
        sizes = np.array([len(d[0]) for d in docs])
        lanes = self._deal(sizes)
        order = np.concatenate(lanes)
        reads, classes, places = (np.concatenate([docs[i][k] for i in order]) for k in range(3))
        lengths = np.array([sizes[lane].sum() for lane in lanes])
        offsets = np.cumsum(lengths) - lengths
        begins = np.cumsum(sizes[order]) - sizes[order]
        first = np.zeros(len(reads), dtype=bool)
        first[begins] = True
        h = np.zeros((len(lanes), HIDDEN), np.float32)
        if carried is not None:
            lane = next(k for k, own in enumerate(lanes) if own[0] == 0)
            h[lane], first[offsets[lane]] = carried, False
        out = np.zeros(len(reads))
        cell = Cell(self.p, len(lanes))
        z, g = np.empty((2, len(lanes), HIDDEN), np.float32)
        at = n = 0
        while (at := at + n) < lengths[0]:
            wide = int((lengths > at).sum())
            n = min(-(-STATES // wide), int(lengths[0]) - at)
            valid = at + np.arange(n)[:, None] < lengths[:wide]
            spots = np.where(valid, offsets[:wide] + at + np.arange(n)[:, None], offsets[:wide])
            (to_gate, to_candidate), starts, states = cell.inputs(reads[spots]), first[spots] & valid, np.empty((n, wide, HIDDEN), np.float32)
            any_start, active = starts.any(1), valid.sum(1)
            for t in range(n):
                k = int(active[t])  # lanes stand by length, so those that go on are the first
                if any_start[t]:
                    h[:wide][starts[t]] = 0
                cell.step(to_gate[t, :k], to_candidate[t, :k], h[:k], z[:k], g[:k], states[t, :k])
                h[:k] = states[t, :k]
            there = np.flatnonzero(valid)
            own = spots.ravel().take(there)
            out[own] = self.log_probs(states.reshape(-1, HIDDEN).take(there, axis=0), classes.take(own), places.take(own))
        sums = np.empty(len(docs))
        sums[order] = np.add.reduceat(out, begins)
        return sums, h[next(k for k, own in enumerate(lanes) if own[-1] == len(docs) - 1)].copy()

    @staticmethod
    def _deal(sizes: np.ndarray) -> list[np.ndarray]:
        """Numbers of the sequences of each lane, in ascending order; the longest lane first."""
        n = int(np.clip(sizes.sum() // max(512, sizes.max()), 1, LANES))
        heap = [(0, k) for k in range(n)]
        lanes: list[list[int]] = [[] for _ in range(n)]
        for i in np.argsort(-sizes, kind="stable").tolist():
            length, k = heapq.heappop(heap)
            lanes[k].append(i)
            heapq.heappush(heap, (length + int(sizes[i]), k))
        return [np.array(sorted(lanes[k])) for _, k in sorted(((-length, k) for length, k in heap)) if lanes[k]]
