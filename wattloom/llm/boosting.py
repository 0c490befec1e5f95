"""Gradient-boosted trees: of a sample, by numpy histograms with monotonic constraints, or of all rows of a table, by histograms that Spark sums; flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.session import discard, materialize


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays.  A leaf has feature -1; ``roots`` are the trees' first nodes."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row: every row walks all trees at once."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at])
            at = np.where(f < 0, at, down)
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))

    def sql(self, names: list[str]) -> str:
        """The log-odds as one SQL expression over columns ``names``."""
        def node(i: int) -> str:
            if self.feature[i] < 0:
                return f"{self.value[i]:.9g}D"
            test = f"{names[self.feature[i]]} <= {self.threshold[i]:.9g}D"
            return f"if({test}, {node(self.left[i])}, {node(self.right[i])})"
        return " + ".join([f"{self.base:.9g}D", *(f"({node(r)})" for r in self.roots)])


def fit(x: np.ndarray, y: np.ndarray, *, monotone: dict[int, int] | None = None, trees: int = 60, depth: int = 3,
        rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: int = 5) -> Forest:
    """Boost log-loss trees.  ``monotone`` maps a feature to +1 or -1: the score may only rise or fall with it.

    A split against its constraint is refused, and the children's values are
    kept on their sides of the midpoint all the way down.  Needs both classes.
    """
    x, y = np.asarray(x, float), np.asarray(y, float)
    if not 0 < y.sum() < len(y):
        raise ValueError("both classes are needed")
    monotone = monotone or {}
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    score = np.full(len(y), base)
    nodes: list[list[float]] = []
    roots = []

    def best(rows, g, h, low, high):
        found = None
        total = lambda a, b, w: -(a * w + 0.5 * (b + l2) * w * w)
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            b, n = binned[rows, f], len(c) + 1
            gl, hl = (np.cumsum(np.bincount(b, v[rows], n))[:-1] for v in (g, h))
            count = np.cumsum(np.bincount(b, minlength=n))[:-1]
            gr, hr = g[rows].sum() - gl, h[rows].sum() - hl
            wl, wr = np.clip(-gl / (hl + l2), low, high), np.clip(-gr / (hr + l2), low, high)
            gain = total(gl, hl, wl) + total(gr, hr, wr)
            allowed = (count >= least) & (len(rows) - count >= least) & (monotone.get(f, 0) * (wr - wl) >= 0)
            gain = np.where(allowed, gain, -np.inf)
            k = int(np.argmax(gain))
            if found is None or gain[k] > found[0]:
                found = gain[k], f, k, wl[k], wr[k]
        w = np.clip(-g[rows].sum() / (h[rows].sum() + l2), low, high)
        own = total(g[rows].sum(), h[rows].sum(), w)
        return w, found if found and found[0] > own + 1e-9 else None

    def grow(rows, g, h, level, low, high) -> int:
        w, split = best(rows, g, h, low, high)
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, rate * w])
        if level == depth or split is None:
            score[rows] += rate * w
            return at
        _, f, k, wl, wr = split
        middle, sign = (wl + wr) / 2, monotone.get(f, 0)
        sides = {0: (low, high, low, high), 1: (low, middle, middle, high), -1: (middle, high, low, middle)}[sign]
        goes_left = binned[rows, f] <= k
        nodes[at][:2] = [f, cuts[f][k]]
        nodes[at][2] = grow(rows[goes_left], g, h, level + 1, *sides[:2])
        nodes[at][3] = grow(rows[~goes_left], g, h, level + 1, *sides[2:])
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), 0, -np.inf, np.inf))
    a = np.array(nodes)
    return Forest(a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], np.array(roots), base, depth)


#: Gradients are summed as integers of this share, so that the order of rows does not matter; scores are told apart by as much.
_UNIT, _SCORES = 1 << 30, 1000


def _steps(value: Column) -> Column:
    """Numbers from 0 on with eleven binary digits kept, so that few are distinct in a table of any size."""
    unit = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(value, F.lit(1.0)))) - 11)
    return F.floor(value / unit) * unit


def _cuts(rows: DataFrame, n_features: int, bins: int) -> dict[str, list[list[float]]]:
    """Quantiles of every feature of a model's rows, each once, without the largest value."""
    values = rows.select("model", F.posexplode("x").alias("feature", "v")).groupBy("model", "feature", _steps(F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("model", "feature")
    upto, total = F.sum("n").over(own.orderBy("v")), F.sum("n").over(own)
    at = F.floor(upto * bins / total)
    ranked = values.select("model", "feature", "v", at.alias("at"), F.floor((upto - F.col("n")) * bins / total).alias("before"), F.max("v").over(own).alias("last"))
    out: dict[str, list[list[float]]] = {}
    for r in ranked.where("at > before and v < last").select("model", "feature", "v").collect():
        out.setdefault(r.model, [[] for _ in range(n_features)])[r.feature].append(r.v)
    return {m: [sorted(c) for c in cuts] for m, cuts in out.items()}


def _by_model(of: dict[str, str], other: str) -> str:
    return "case " + " ".join(f"when model = '{m}' then {e}" for m, e in of.items()) + f" else {other} end" if of else other


def _walk(tree: dict[int, tuple], leaf, node: int = 1) -> str:
    """A tree over ``b``, the numbers of cuts under a row's values, as SQL; ``leaf`` gives what stands at a node's end."""
    if len(tree.get(node, ())) == 2:
        f, k = tree[node]
        return f"if(b[{f}] <= {k}, {_walk(tree, leaf, 2 * node)}, {_walk(tree, leaf, 2 * node + 1)})"
    return leaf(node)


def fit_all(rows: DataFrame, n_features: int, *, trees: int, depth: int, rate: float, bins: int = 64, l2: float = 1.0, least: int = 5,
            precision: float) -> dict[str, tuple[Forest, float | None]]:
    """Forests of several models, each of all its rows, and the lowest score from which on its held-out rows reach ``precision``.

    ``rows (model, held, y, x)``: which model, whether held out, the class and
    an array of numbers from 0 on.  Log-loss trees as those of ``fit``, grown
    together a level at a time by sums that Spark makes over all rows; only
    the sums of bins, the cuts and the counts of scores (told apart to a
    thousandth) come to the driver, however many rows there are.  A model
    without both classes among rows that are not held out is missing, the score
    of one that never reaches ``precision`` is None.
    """
    train = rows.where("not held")
    counts = train.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if("y").alias("yes")).collect()
    base = {r.model: float(np.log(r.yes / (r.n - r.yes))) for r in counts if 0 < r.yes < r.n}
    if not base:
        return {}
    cuts = _cuts(train.where(F.col("model").isin(*base)), n_features, bins)
    cuts = {m: cuts.get(m, [[] for _ in range(n_features)]) for m in base}
    spark = rows.sparkSession
    known = F.broadcast(spark.createDataFrame([*cuts.items()], "model string, cuts array<array<double>>"))
    found = rows.join(known, "model").select("model", "held", "y", F.expr(
        "transform(x, (v, i) -> cast(size(filter(cuts[i], c -> c < v)) as smallint))").alias("b"))
    found = materialize(found.groupBy("model", "held", "y", "b").agg(F.count(F.lit(1)).alias("n")))  # equal rows once
    grown: dict[str, list[dict[int, tuple]]] = {m: [] for m in base}

    def scores() -> str:
        return _by_model({m: " + ".join([f"{base[m]!r}D", *(f"({_walk(t, lambda i: f'{t[i][0]!r}D')})" for t in own)]) for m, own in grown.items()}, "0D")

    def weight(g, h):
        return -g / (h + l2)

    def total(g, h):
        w = weight(g, h)
        return -(g * w + 0.5 * (h + l2) * w * w)

    for _ in range(trees):
        p = 1 / (1 + F.exp(-F.expr(scores())))
        part = lambda v: F.round(v * _UNIT).cast("long") * F.col("n")
        slope = found.where("not held").select("model", "b", "n", part(p - F.col("y").cast("int")).alias("g"), part(F.greatest(p * (1 - p), F.lit(1e-6))).alias("h"))
        new: dict[str, dict[int, tuple]] = {m: {} for m in base}
        for level in range(depth):
            node = _by_model({m: _walk(t, lambda i: "0" if i in t else str(i)) for m, t in new.items()}, "0")
            summed = slope.select("model", F.expr(node).alias("node"), F.posexplode("b").alias("feature", "bin"), "n", "g", "h").where("node > 0") \
                .groupBy("model", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ngh"]).collect()
            tables: dict[tuple[str, int], list[np.ndarray]] = {}
            for r in summed:
                own = tables.setdefault((r.model, r.node), [np.zeros((3, len(c) + 1)) for c in cuts[r.model]])
                own[r.feature][:, r.bin] = r.n, r.g / _UNIT, r.h / _UNIT
            for (m, i), own in tables.items():
                _, g, h = own[0].sum(axis=1)
                best = None
                for f, table in enumerate(own):
                    n, left_g, left_h = np.cumsum(table, axis=1)[:, :-1]
                    gain = np.where((n >= least) & (table[0].sum() - n >= least), total(left_g, left_h) + total(g - left_g, h - left_h), -np.inf)
                    k = int(np.argmax(gain)) if len(gain) else 0
                    if len(gain) and (best is None or gain[k] > best[0]):
                        best = gain[k], f, k, left_g[k], left_h[k]
                if best is None or best[0] <= total(g, h) + 1e-9:
                    new[m][i] = (float(rate * weight(g, h)),)
                    continue
                _, f, k, left_g, left_h = best
                new[m][i] = f, k
                if level == depth - 1:
                    new[m][2 * i], new[m][2 * i + 1] = (float(rate * weight(left_g, left_h)),), (float(rate * weight(g - left_g, h - left_h)),)
        for m in base:
            grown[m].append(new[m])

    score = F.floor(F.expr(scores()) * _SCORES).alias("score")
    held = found.where("held").select("model", "y", "n", score).groupBy("model", "score").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("y"), F.col("n")).otherwise(0)).alias("yes")).collect()
    discard(found)
    out = {}
    for m, own in grown.items():
        n = yes = 0
        lowest = None
        for r in sorted((r for r in held if r.model == m), key=lambda r: -r.score):
            n, yes = n + r.n, yes + r.yes
            if yes >= precision * n:
                lowest = r.score / _SCORES
        out[m] = _flat(own, cuts[m], base[m], depth), lowest
    return out


def _flat(trees: list[dict[int, tuple]], cuts: list[list[float]], base: float, depth: int) -> Forest:
    nodes: list[list[float]] = []

    def put(tree, i) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, 0.0])
        if len(tree[i]) == 1:
            nodes[at][4] = tree[i][0]
        else:
            f, k = tree[i]
            nodes[at][:2] = [f, cuts[f][k]]
            nodes[at][2] = put(tree, 2 * i)
            nodes[at][3] = put(tree, 2 * i + 1)
        return at

    roots = [put(t, 1) for t in trees]
    a = np.array(nodes, float).reshape(-1, 5)
    return Forest(a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], np.array(roots), base, depth)
