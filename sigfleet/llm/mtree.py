"""M-tree over integer vectors: build, and best-first search for inner products.

Maximum inner product search becomes nearest-neighbour search in a metric
space by one more coordinate: with ``R`` the largest norm, a vector ``x`` is
placed at ``(x, sqrt(R^2 - |x|^2))`` and a query at ``(q, 0)``, so that
``d^2 = |q|^2 + R^2 - 2 q.x``. The tree holds pages of entries; every entry
of an inner page has a routing object, the covering radius of its subtree and
the distance to the routing object of its parent page, every entry of a leaf
its distance to the page's routing object.

The search keeps pages in a heap by the least distance any of their objects
can have. Within a page, ``|d(q, parent) - d(entry, parent)|`` bounds the
distance of an entry from below with a stored distance only; entries it rules
out are never computed. Bounds are compared with a small slack in floating
point, scores are exact integers, so results are exact.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

PAGE = 64


@dataclass
class Page:
    leaf: bool
    to_parent: np.ndarray  # distance of each entry to the page's routing object
    points: np.ndarray | None  # routing objects (inner)
    members: np.ndarray  # child pages (inner) or row numbers (leaf)
    radii: np.ndarray | None  # covering radii (inner)


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    diff = points - to
    return np.sqrt(np.einsum("ij,ij->i", diff, diff))


def lift(vectors: np.ndarray, radius2: float) -> np.ndarray:
    """The vectors with their extra coordinate, as float64."""
    v = vectors.astype(np.float64)
    extra = np.sqrt(np.maximum(0.0, radius2 - np.einsum("ij,ij->i", v, v)))
    return np.hstack([v, extra[:, None]])


class MTree:
    """A tree over the rows of one bounded block of vectors.

    Built from above: rows are dealt to the nearest of ``PAGE`` routing
    objects, spread out by farthest-first choice, until a page holds them.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, radius2: float) -> None:
        self.vectors, self.ids = vectors, ids
        self.pages: list[Page] = []
        self._lifted = lift(vectors, radius2)
        rows = np.arange(len(vectors))
        center = self._lifted.mean(axis=0) if len(rows) else np.zeros(vectors.shape[1] + 1)
        self.center = center
        d = _distances(self._lifted, center)
        self.radius = float(d.max()) if len(rows) else 0.0
        self.root = self._build(rows, center, d)

    def state(self) -> tuple:
        """What a stored tree consists of."""
        pages = [(p.leaf, p.to_parent, p.points, p.members, p.radii) for p in self.pages]
        return self.vectors, self.ids, self.center, self.radius, self.root, pages

    @classmethod
    def from_state(cls, state: tuple) -> MTree:
        tree = cls.__new__(cls)
        tree.vectors, tree.ids, tree.center, tree.radius, tree.root, pages = state
        tree.pages = [Page(*p) for p in pages]
        return tree

    def _build(self, rows: np.ndarray, center: np.ndarray, d: np.ndarray) -> int:
        if len(rows) <= PAGE or float(d.max()) == 0.0:
            return self._add(Page(True, d, None, rows, None))
        routing, near = self._spread(rows)
        children, radii, kept = [], [], []
        for k in range(len(routing)):
            own = rows[near == k]
            if not len(own):
                continue
            at = routing[k]
            dd = _distances(self._lifted[own], at)
            children.append(self._build(own, at, dd))
            radii.append(float(dd.max()))
            kept.append(at)
        points = np.stack(kept)
        return self._add(
            Page(False, _distances(points, center), points, np.array(children), np.array(radii))
        )

    def _spread(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Routing objects among ``rows``, farthest first, and the nearest of each row."""
        x = self._lifted[rows]
        k = min(PAGE, max(2, len(rows) // (PAGE // 2)))
        chosen = [int(np.argmax(_distances(x, x[0])))]
        least = _distances(x, x[chosen[0]])
        near = np.zeros(len(rows), int)
        while len(chosen) < k:
            far = int(np.argmax(least))
            if least[far] == 0.0:
                break
            d = _distances(x, x[far])
            closer = d < least
            near[closer] = len(chosen)
            least[closer] = d[closer]
            chosen.append(far)
        return x[chosen], near

    def _add(self, page: Page) -> int:
        self.pages.append(page)
        return len(self.pages) - 1

    def search(
        self, query: np.ndarray, own: tuple[int, ...], k: int, radius2: float, floor: int | None
    ) -> list[tuple[int, int, int]]:
        """Up to ``k`` best ``(-score, id, row)``, smallest first.

        ``own`` are row numbers to leave out. ``floor``: a score that ``k``
        others are known to reach; lower ones may be left out.
        """
        q = np.append(query.astype(np.float64), 0.0)
        q2 = float(q @ q)
        best: list[tuple[int, int, int]] = []  # a heap of (score, -id, row): the worst on top
        d0 = float(np.sqrt(((q - self.center) ** 2).sum()))
        heap = [(max(0.0, d0 - self.radius), 0, self.root, d0)]
        tick = 0
        limit = self._reach(floor, q2, radius2)
        while heap:
            least, _, number, d_parent = heapq.heappop(heap)
            if least > limit:
                break
            page = self.pages[number]
            slack = 1e-9 * (d_parent + 1.0)
            gap = np.abs(d_parent - page.to_parent) - slack
            if page.leaf:
                rows = page.members[gap <= limit]
                if len(rows):
                    scores = self.vectors[rows] @ query
                    self._offer(best, rows, scores, own, k)
                    if len(best) == k:
                        worst = best[0][0] if floor is None else max(best[0][0], floor)
                        limit = min(limit, self._reach(worst, q2, radius2))
                continue
            keep = np.flatnonzero(gap - page.radii <= limit)
            if not len(keep):
                continue
            d = _distances(page.points[keep], q)
            bound = np.maximum(0.0, d - page.radii[keep] - 1e-9 * (d + 1.0))
            for j in np.flatnonzero(bound <= limit):
                tick += 1
                heapq.heappush(
                    heap, (float(bound[j]), tick, int(page.members[keep[j]]), float(d[j]))
                )
        return sorted((-s, -i, r) for s, i, r in best)

    @staticmethod
    def _reach(score: int | None, q2: float, radius2: float) -> float:
        """The distance within which every score of at least ``score`` lies."""
        if score is None:
            return float("inf")
        square = max(0.0, q2 + radius2 - 2.0 * float(score))
        return float(np.sqrt(square + 1e-7 * (q2 + radius2 + 1.0)))

    def _offer(self, best, rows, scores, own, k) -> None:
        if len(best) == k:
            ok = scores >= best[0][0]
            rows, scores = rows[ok], scores[ok]
        for r, s in zip(rows.tolist(), scores.tolist(), strict=True):
            if r in own:
                continue
            item = (s, -int(self.ids[r]), r)
            if len(best) < k:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
