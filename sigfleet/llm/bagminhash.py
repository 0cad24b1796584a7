"""BagMinHash signatures of weighted sets, in numpy.

The multiset of a text's word 5-grams is a weighted set: element = 5-gram,
weight = how often it occurs. Over the weight axis, cut into the intervals
[0,1), [1,2), [2,4), [4,8), ..., every element has independent Poisson
processes, one per interval, with the interval's length as rate; a point of a
process belongs to a unit slot of its interval (found by halving the
interval, one hash bit per level) and to one of the ``m`` components. An
element of weight ``w`` owns the points in slots below ``w``. Each component
keeps its earliest point, so two texts agree in a component with probability
sum(min(weights)) / sum(max(weights)), the weighted Jaccard similarity.

Points are generated in order of time and only while they can still be the
earliest of some component, so the work is about n + m log m per text and
does not grow with the weights.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_U = np.uint64
_PRIME = 0x9E3779B97F4A7C15
_BASE = 0x100000001B3
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift-multiply rounds)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def normal_words(text: str | None) -> list[str]:
    """Lower-cased words, split at white space."""
    return text.lower().split() if text else []


class Shingler:
    """Word 5-gram hashes of a text, from a rolling hash over its bytes."""

    def __init__(self) -> None:
        self._powers = np.ones(1, _U)
        self._inverse = np.ones(1, _U)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            n = max(n, 2 * len(self._powers))
            with np.errstate(over="ignore"):
                full = np.full(n, _BASE, _U)
                full[0] = 1
                self._powers = np.cumprod(full)
                full[1:] = pow(_BASE, -1, 1 << 64)
                self._inverse = np.cumprod(full)

    def hashes(self, words: list[str]) -> np.ndarray:
        """One hash per 5-gram; a text of 1 to 4 words is one gram; none: empty."""
        n = len(words)
        if not n:
            return np.empty(0, _U)
        data = np.frombuffer(" ".join(words).encode("utf-8", "surrogatepass"), np.uint8)
        self._grow(len(data) + 1)
        with np.errstate(over="ignore"):
            prefix = np.zeros(len(data) + 1, _U)
            np.cumsum((data.astype(_U) + _U(1)) * self._powers[: len(data)], out=prefix[1:])
            blanks = np.flatnonzero(data == 32)
            start = np.concatenate(([0], blanks + 1))
            end = np.concatenate((blanks, [len(data)]))
            word = mix((prefix[end] - prefix[start]) * self._inverse[start] + _U(1))
            k = min(WORDS, n)
            out = np.zeros(n - k + 1, _U)
            for j in range(k):
                out = (out + word[j : j + len(out)]) * _U(_PRIME)
            return mix(out + _U(k))


def bag(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different hashes and their counts."""
    return np.unique(hashes, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two bags; 0 if either is empty."""
    total = int(a[1].sum()) + int(b[1].sum())
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (total - both)


def _processes(elements: np.ndarray, weights: np.ndarray):
    """Seed, rate, first slot and weight of every (element, interval) in use."""
    seeds, lows, lens, tops = [], [], [], []
    low, length, level = 0, 1, 0
    e, w = elements, weights
    with np.errstate(over="ignore"):
        while len(e):
            seeds.append(mix(e + _U((_PRIME * (level + 1)) & _MASK)))
            lows.append(np.full(len(e), low, np.int64))
            lens.append(np.full(len(e), length, np.int64))
            tops.append(w)
            low += length
            more = w > low
            e, w = e[more], w[more]
            length = low
            level += 1
    return (np.concatenate(seeds), np.concatenate(lens), np.concatenate(lows), np.concatenate(tops))


def signature(elements: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """``m`` component values (uint64); elements must not be empty."""
    start = _processes(elements, weights.astype(np.int64))
    total = float(weights.sum())
    # All components have a point by this time but for about one text in 50;
    # those are done again over a longer time.
    until = m / total * (np.log(m) + 4.0)
    while True:
        times, points = _points(*start, until)
        comp = (points % _U(m)).astype(np.int64)
        best = np.full(m, np.inf)
        np.minimum.at(best, comp, times)
        if np.isfinite(best).all():
            break
        until *= 2.0
    value = np.zeros(m, _U)
    first = times == best[comp]
    value[comp[first]] = points[first]
    return mix(value)


def _points(seed, length, low, top, until: float) -> tuple[np.ndarray, np.ndarray]:
    """Time and hash of every accepted point before ``until``."""
    now = np.zeros(len(seed))
    count = _U(0)
    mean = until * float(length.max())
    steps = int(min(64, np.ceil(mean + 0.5 * np.sqrt(mean))))
    times, points = [], []
    simple = int(length.max()) == 1
    with np.errstate(over="ignore"):
        while len(seed):
            counter = count + np.arange(1, steps + 1, dtype=_U)
            count = counter[-1]
            r1 = mix(seed[:, None] + (counter * _U(_PRIME))[None, :])
            gap = -np.log(((r1 >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53)
            if not simple:
                gap /= length[:, None]
            t = np.cumsum(gap, axis=1) if steps > 1 else gap
            t += now[:, None]
            ok = t < until
            if not simple:  # the slot, by halving the interval
                half = (mix(r1 ^ _U(0xA5A5A5A5A5A5A5A5)) >> _U(8)) % length[:, None].astype(_U)
                ok &= low[:, None] + half.astype(np.int64) < top[:, None]
            times.append(t[ok])
            points.append(mix(r1[ok] + _U(1)))
            now = t[:, -1]
            alive = now < until
            seed, length, low, top, now = (x[alive] for x in (seed, length, low, top, now))
            steps = max(1, min(steps, 8))
    return np.concatenate(times), np.concatenate(points)


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` components."""
    bands = sig.reshape(-1, rows)
    with np.errstate(over="ignore"):
        key = np.arange(1, len(bands) + 1, dtype=_U) * _U(_PRIME)
        for j in range(rows):
            key = mix(key + bands[:, j])
    return key
