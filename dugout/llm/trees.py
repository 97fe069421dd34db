"""Small binary trees on histograms, for models fitted on a bounded sample on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Tree:
    """Nodes as arrays; a node without a feature (-1) is a leaf. Rows with x <= threshold go left."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                return node
            down = x[rows, np.maximum(feature, 0)] <= self.threshold[node]
            node = np.where(inner, np.where(down, self.left[node], self.right[node]), node)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(x)]

    def paths(self) -> list[list[tuple[int, bool, float]]]:
        """Conditions from the root to every node below it: (feature, whether x <= threshold, threshold)."""
        out, todo = [], [(0, [])]
        while todo:
            node, path = todo.pop()
            if path:
                out.append(path)
            if self.feature[node] >= 0:
                test = (int(self.feature[node]), float(self.threshold[node]))
                todo.append((int(self.left[node]), [*path, (test[0], True, test[1])]))
                todo.append((int(self.right[node]), [*path, (test[0], False, test[1])]))
        return out


class Grower:
    """Grows trees over the same rows; a cut lies halfway between two values that occur."""

    def __init__(self, x: np.ndarray) -> None:
        self.cuts, self.codes = [], np.zeros(x.shape, np.uint8)
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            if len(values) > BINS:
                values = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS), method="lower"))
            cuts = (values[1:] + values[:-1]) / 2
            self.cuts.append(cuts)
            self.codes[:, j] = np.searchsorted(cuts, x[:, j], side="left")

    def grow(self, slope: np.ndarray, curve: np.ndarray, depth: int, least: float = 1.0, ridge: float = 1.0, tries: int | None = None, rng: np.random.Generator | None = None) -> Tree:
        """A tree whose leaves minimise slope * v + curve * v^2 / 2; rows of zero curve don't take part.

        ``least`` is the smallest curve of a leaf, ``tries`` the number of features drawn for a split.
        """
        nodes: list[list] = []

        def node(rows: np.ndarray, level: int) -> int:
            own = len(nodes)
            g, h = slope[rows].sum(), curve[rows].sum()
            nodes.append([-1, 0.0, -1, -1, -g / (h + ridge) if h else 0.0])
            if level == depth or h < 2 * least:
                return own
            best, cut = 1e-9, None
            width = self.codes.shape[1]
            drawn = range(width) if tries is None or tries >= width else np.sort(rng.permutation(width)[:tries])
            for j in drawn:
                size = len(self.cuts[j]) + 1
                if size < 2:
                    continue
                codes = self.codes[rows, j]
                gs = np.cumsum(np.bincount(codes, slope[rows], size))[:-1]
                hs = np.cumsum(np.bincount(codes, curve[rows], size))[:-1]
                gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
                gain[(hs < least) | (h - hs < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best:
                    best, cut = gain[k], (int(j), k)
            if cut is not None:
                j, k = cut
                low = self.codes[rows, j] <= k
                nodes[own][:2] = j, self.cuts[j][k]
                nodes[own][2] = node(rows[low], level + 1)
                nodes[own][3] = node(rows[~low], level + 1)
            return own

        node(np.flatnonzero(curve > 0), 0)
        kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
        return Tree(*(np.array(c, k) for c, k in zip(zip(*nodes, strict=True), kinds, strict=True)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Boosted:
    """Gradient-boosted trees for a yes or no."""

    base: float
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.base + sum((t.predict(x) for t in self.trees), np.zeros(len(x))))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.2, least: float = 2.0) -> Boosted:
    """Logistic boosting with Newton leaves."""
    share = min(max((y.sum() + 0.5) / (len(y) + 1), 1e-3), 1 - 1e-3)
    base, trees = float(np.log(share / (1 - share))), []
    if len(y) and 0 < y.sum() < len(y):
        grower, score = Grower(x), np.full(len(y), base)
        for _ in range(rounds):
            p = sigmoid(score)
            tree = grower.grow(p - y, p * (1 - p), depth, least=least * 0.05)
            tree.value *= rate
            trees.append(tree)
            score += tree.predict(x)
    return Boosted(base, trees)


@dataclass
class Forest:
    """Mean of the leaves' shares of yes."""

    share: float
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(x), self.share)
        return sum(t.predict(x) for t in self.trees) / len(self.trees)


def forest(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 8, seed: int = 7) -> Forest:
    """Trees on rows drawn with replacement, with a random part of the features at every split."""
    rng, grown = np.random.default_rng(seed), []
    share = float(y.mean()) if len(y) else 0.0
    if len(y) and 0 < y.sum() < len(y):
        grower = Grower(x)
        for _ in range(trees):
            weight = np.bincount(rng.integers(len(y), size=len(y)), minlength=len(y)).astype(float)
            grown.append(grower.grow(-y * weight, weight, depth, least=2, ridge=1e-6, tries=max(1, int(np.sqrt(x.shape[1])) + 1), rng=rng))
    return Forest(share, grown)
