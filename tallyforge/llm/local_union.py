"""Union-find inside a task, over vectorised batches of links."""

from __future__ import annotations

import numpy as np


class Union:
    """Classes of the positions 0 .. n - 1; a class is named by its smallest position."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        """The root of every position."""
        while True:
            above = self.parent[self.parent]
            if (above == self.parent).all():
                return self.parent
            self.parent = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the classes of a[i] and b[i] for all i."""
        while len(a):
            root = self.roots()
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                return
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(self.parent, high, low)
