"""Small decision trees, forests and boosted trees in NumPy.

Training tables here are generated, a few thousand rows, so exact greedy splits
over at most ``CUTS`` thresholds a feature do.  Everything is seeded; fitting
the same table twice gives the same trees.  A tree is either a float (leaf) or
(feature, threshold, tree if value <= threshold, tree otherwise).
"""

from __future__ import annotations

from math import exp

import numpy as np

CUTS = 48


def fit_tree(x: np.ndarray, y: np.ndarray, h: np.ndarray, depth: int, least: int = 5, rng=None, features: int | None = None, penalty: float = 1e-9):
    """A tree for weighted targets: leaves hold sum(y) / (sum(h) + penalty)."""
    value = float(y.sum() / (h.sum() + penalty))
    if depth == 0 or len(y) < 2 * least:
        return value
    chosen = range(x.shape[1]) if features is None else sorted(rng.choice(x.shape[1], features, replace=False))
    best, base = None, y.sum() ** 2 / (h.sum() + penalty)
    for f in chosen:
        col = x[:, f]
        cuts = np.unique(col)
        if len(cuts) < 2:
            continue
        cuts = (cuts[1:] + cuts[:-1]) / 2
        if len(cuts) > CUTS:
            cuts = cuts[np.linspace(0, len(cuts) - 1, CUTS).astype(int)]
        side = np.searchsorted(cuts, col, side="left")  # rows with col <= cuts[i] have side <= i
        n, sy, sh = (np.cumsum(np.bincount(side, w, len(cuts) + 1))[:-1] for w in (np.ones_like(y), y, h))
        gain = sy**2 / (sh + penalty) + (y.sum() - sy) ** 2 / (h.sum() - sh + penalty) - base
        gain[(n < least) | (len(y) - n < least)] = -1
        i = int(np.argmax(gain))
        if gain[i] > 1e-9 and (best is None or gain[i] > best[0] + 1e-12):
            best = gain[i], f, float(cuts[i])
    if best is None:
        return value
    _, f, t = best
    go = x[:, f] <= t
    rest = depth - 1, least, rng, features, penalty
    return int(f), t, fit_tree(x[go], y[go], h[go], *rest), fit_tree(x[~go], y[~go], h[~go], *rest)


def tree_value(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def tree_values(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    go = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[go], out[~go] = tree_values(tree[2], x[go]), tree_values(tree[3], x[~go])
    return out


def tree_sql(tree, names: list[str]) -> str:
    """The tree as a SQL expression over columns ``names``."""
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    return f"CASE WHEN {names[tree[0]]} <= {tree[1]!r}D THEN {tree_sql(tree[2], names)} ELSE {tree_sql(tree[3], names)} END"


def fit_boosted(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3) -> list:
    """Logistic boosting by Newton steps; the sum of the trees is a log odds."""
    trees, score = [], np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = fit_tree(x, y - p, p * (1 - p), depth, penalty=1.0)
        tree = _scaled(tree, rate)
        trees.append(tree)
        score += tree_values(tree, x)
    return trees


def _scaled(tree, by: float):
    return (tree[0], tree[1], _scaled(tree[2], by), _scaled(tree[3], by)) if isinstance(tree, tuple) else tree * by


def boosted_scores(trees: list, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-sum(tree_values(t, x) for t in trees)))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 8, seed: int = 0) -> list:
    rng = np.random.default_rng(seed)
    some = max(1, int(np.ceil(np.sqrt(x.shape[1]))))
    found = []
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        found.append(fit_tree(x[rows], y[rows].astype(float), np.ones(len(y)), depth, 2, rng, some))
    return found


def forest_value(forest: list, row) -> float:
    return sum(tree_value(t, row) for t in forest) / len(forest)


def threshold_for(scores: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The threshold that selects the most rows at the wanted precision, put
    half-way to the next lower score; infinite if there is none."""
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(y[order])
    # equal scores are selected together
    last = np.append(s[1:] != s[:-1], True) if len(s) else np.zeros(0, bool)
    ok = np.flatnonzero((hits / np.arange(1, len(s) + 1) >= precision) & last)
    if not len(ok):
        return float("inf")
    return float((s[ok[-1]] + s[ok[-1] + 1]) / 2 if ok[-1] + 1 < len(s) else s[ok[-1]])


def as_arrays(trees: list, depth: int) -> tuple[list[int], list[float], list[float]]:
    """Trees as full binary ones in flat arrays: the inner nodes' features and
    thresholds, tree by tree and level by level (2**depth - 1 each), and the
    leaves (2**depth each)."""
    which, cuts, leaves = [], [], []
    for tree in trees:
        level = [tree]
        for _ in range(depth):
            below = []
            for node in level:
                f, cut, low, high = node if isinstance(node, tuple) else (0, 0.0, node, node)
                which.append(f)
                cuts.append(cut)
                below += [low, high]
            level = below
        leaves += level
    return which, cuts, leaves


def logistic(z: float) -> float:
    return 1 / (1 + exp(-z))
