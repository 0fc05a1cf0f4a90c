"""Search whose next point depends on the losses so far.

After some random points, those with the least losses are the good ones. For
each parameter a density is laid over the good points and one over the others,
a sum of normal curves as wide as the points are apart. Of some candidates drawn
from the good density, the one with the greatest ratio of both is tried next.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Range:
    """From ``low`` to ``high``, on a log scale or in whole numbers if so said."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def inside(self, u: float) -> float:
        """The value at a share of the range."""
        if self.log:
            value = math.exp(math.log(self.low) + u * (math.log(self.high) - math.log(self.low)))
        else:
            value = self.low + u * (self.high - self.low)
        return min(int(self.high), int(self.low) + int(u * (self.high - self.low + 1))) if self.whole else value


@dataclass(frozen=True)
class Search:
    ranges: dict[str, Range]
    seed: int = 999
    #: Points drawn at random first, share of points that are good, candidates of which the best ratio is tried.
    first: int = 8
    good: float = 0.25
    candidates: int = 24

    def next(self, tried: Sequence[tuple[dict[str, float], float]]) -> dict[str, float]:
        """Shares of the ranges to try after the points ``tried`` (shares, loss); the same for the same past."""
        rng = random.Random(f"{self.seed}/{len(tried)}")
        if len(tried) < self.first:
            return {name: rng.random() for name in self.ranges}
        ranked = sorted(tried, key=lambda t: t[1])
        n = max(2, math.ceil(self.good * len(ranked)))
        good, rest = [p for p, _ in ranked[:n]], [p for p, _ in ranked[n:]]
        point = {}
        for name in self.ranges:
            a, b = sorted(p[name] for p in good), sorted(p[name] for p in rest)
            drawn = [self._draw(rng, a) for _ in range(self.candidates)]
            point[name] = max(drawn, key=lambda u: self._density(u, a) / self._density(u, b))
        return point

    @staticmethod
    def _widths(points: list[float]) -> list[float]:
        """A curve reaches to the farther of its neighbours or ends of the range, but is never all too narrow."""
        ends = [0.0, *points, 1.0]
        least = 1 / (10 + len(points))
        return [max(least, ends[i] - ends[i - 1], ends[i + 1] - ends[i]) for i in range(1, len(ends) - 1)]

    def _draw(self, rng: random.Random, points: list[float]) -> float:
        i = rng.randrange(len(points) + 1)
        if i == len(points):  # anywhere, now and then
            return rng.random()
        width = self._widths(points)[i]
        while not 0 <= (u := rng.gauss(points[i], width)) <= 1:
            pass
        return u

    def _density(self, u: float, points: list[float]) -> float:
        curves = [math.exp(-0.5 * ((u - p) / w) ** 2) / w for p, w in zip(points, self._widths(points))]
        return (1 + sum(curves)) / (1 + len(points))

    def values(self, point: dict[str, float]) -> dict[str, float]:
        return {name: r.inside(point[name]) for name, r in self.ranges.items()}

    def run(self, loss: Callable[[dict[str, float]], float], trials: int) -> tuple[dict[str, float], list[float]]:
        """Values of the least loss in so many trials, and all losses in order."""
        tried: list[tuple[dict[str, float], float]] = []
        for _ in range(trials):
            point = self.next(tried)
            tried.append((point, loss(self.values(point))))
        best = min(tried, key=lambda t: t[1])[0] if tried else {}
        return (self.values(best) if tried else {}), [t[1] for t in tried]
