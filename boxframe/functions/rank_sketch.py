"""A mergeable summary of numbers that answers quantiles."""

from __future__ import annotations

import numpy as np


class RankSketch:
    """Levels of numbers; one at level ``h`` stands for ``2 ** h`` of the values that were added.

    A level that is full is sorted and every other number goes up, so memory grows with the logarithm of the
    count. Exact up to ``width`` values. Beyond, each halving of level ``h`` moves ranks by at most ``2 ** h``, so a
    rank is off by at most ``log2(n / width) / width`` of ``n``; taking odd and even places in turn keeps the usual
    error far below that. Two sketches are merged level by level, whatever the order.
    """

    def __init__(self, width: int = 2048):
        self.width = width
        self.levels: list[np.ndarray] = [np.empty(0)]
        self.turns = 0

    def add(self, values: np.ndarray) -> RankSketch:
        """Null and NaN values don't count."""
        values = np.asarray(values, float)
        values = values[~np.isnan(values)]
        for start in range(0, len(values), self.width):
            self.levels[0] = np.concatenate([self.levels[0], values[start : start + self.width]])
            self._settle()
        return self

    def merge(self, other: RankSketch) -> RankSketch:
        self.levels += [np.empty(0)] * (len(other.levels) - len(self.levels))
        for height, numbers in enumerate(other.levels):
            self.levels[height] = np.concatenate([self.levels[height], numbers])
        self._settle()
        return self

    def _settle(self) -> None:
        height = 0
        while height < len(self.levels):
            numbers = self.levels[height]
            if len(numbers) > self.width:
                numbers = np.sort(numbers)
                if height + 1 == len(self.levels):
                    self.levels.append(np.empty(0))
                # An odd one out stays, so that the weights still add up to the count.
                even = len(numbers) // 2 * 2
                up = numbers[:even].reshape(-1, 2)[:, self.turns % 2]
                self.turns += 1
                self.levels[height] = numbers[even:]
                self.levels[height + 1] = np.concatenate([self.levels[height + 1], up])
            height += 1

    @property
    def count(self) -> int:
        return sum(len(numbers) << height for height, numbers in enumerate(self.levels))

    def quantile(self, q: float) -> float | None:
        """The least value whose rank reaches ``q`` of the count; none without values."""
        if not self.count:
            return None
        numbers = np.concatenate(self.levels)
        weights = np.concatenate([np.full(len(n), 1 << h) for h, n in enumerate(self.levels)])
        order = np.argsort(numbers, kind="stable")
        rank = max(1, int(np.ceil(q * self.count)))
        return float(numbers[order][np.searchsorted(np.cumsum(weights[order]), rank)])

    def to_bytes(self) -> bytes:
        head = [self.width, self.turns % 2, len(self.levels), *map(len, self.levels)]
        return np.array(head, "<i4").tobytes() + np.concatenate(self.levels).astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> RankSketch:
        width, turns, n = np.frombuffer(data, "<i4", 3)
        sizes = np.frombuffer(data, "<i4", n, 12)
        numbers = np.frombuffer(data, "<f8", offset=12 + 4 * int(n))
        out = cls(int(width))
        out.turns, out.levels = int(turns), [part.copy() for part in np.split(numbers, np.cumsum(sizes)[:-1])]
        return out
