"""Leaf-wise gradient boosting of binary labels over binned features.

Features are binned once; a row is then a byte for each feature, with a bin of its own for missing values. A tree grows best leaf
first. Its histograms of gradients come from Spark: each task adds up its rows by node, feature and bin, a group for each
node and feature adds up the tasks and finds its best cut, and only these cuts reach the driver. All leaves that may
still be cut get the histograms of both their sides in one job, so a tree takes as many jobs as it is deep.

Rows carry the sum of the trees before; every few trees it is written anew, so that a task computes only the latest ones and
a lost executor costs a reread. Losses on both splits ride along with the first job of the next tree.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinloom.config import BoostingConfig
from kinloom.session import ship_package, staged, unstage
from kinloom.sources import tables

#: The bin of missing values; the others are below.
MISSING = 255
BINS = 256
#: Trees after which the rows' sums are written anew.
RESTAGE = 10
#: Least sum of second derivatives on a side.
LEAST_HESSIAN = 1e-3


@dataclass
class Tree:
    """Nodes by number, the root first. feature is -1 in a leaf; a value up to bin `cut` goes left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float, left_value: float, right_value: float) -> tuple[int, int]:
        a = len(self.feature)
        for value in (left_value, right_value):
            for column, x in zip((self.feature, self.cut, self.missing_left, self.left, self.right, self.value, self.gain), (-1, 0, False, -1, -1, value, 0.0), strict=True):
                column.append(x)
        self.feature[node], self.cut[node], self.missing_left[node], self.left[node], self.right[node], self.gain[node] = feature, cut, missing_left, a, a + 1, gain
        return a, a + 1

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(bins), np.int64)
        feature, cut, missing_left, left, right = (np.array(c) for c in (self.feature, self.cut, self.missing_left, self.left, self.right))
        while (open_ := np.flatnonzero(feature[at] >= 0)).size:
            own = at[open_]
            x = bins[open_, feature[own]]
            goes_left = np.where(x == MISSING, missing_left[own], x <= cut[own])
            at[open_] = np.where(goes_left, left[own], right[own])
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]

    def kept(self, accepted: set[int]) -> Tree:
        """The tree without cuts that were only looked at."""
        out, todo = Tree(value=[self.value[0]]), [(0, 0)]
        while todo:
            old, new = todo.pop()
            if old in accepted:
                a, b = self.left[old], self.right[old]
                x, y = out.split(new, self.feature[old], self.cut[old], self.missing_left[old], self.gain[old], self.value[a], self.value[b])
                todo += [(a, x), (b, y)]
        return out


def best_cut(histogram: np.ndarray, config: BoostingConfig) -> tuple[float, int, bool, list[float]] | None:
    """(gain, bin, whether missing values go left, [G, H, n] of both sides) of the best cut of a (BINS, 3) histogram.

    Ties: the lower bin, missing values to the left first. Without any, they go to the side with more rows."""
    total = histogram.sum(axis=0)
    lost, known = histogram[MISSING], np.cumsum(histogram[:MISSING], axis=0)
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + config.lambda_l2)
    best = None
    for missing_left in (True, False):
        left = known + lost if missing_left else known
        right = total - left
        fits = np.ones(MISSING, bool)
        for side in (left, right):
            fits &= (np.rint(side[:, 2]) >= config.min_data_in_leaf) & (side[:, 1] >= LEAST_HESSIAN)
        if not fits.any():
            continue
        gains = np.where(fits, score(left) + score(right) - score(total), -np.inf)
        k = int(gains.argmax())
        if gains[k] > 1e-12 and (best is None or gains[k] > best[0]):
            to_left = missing_left if lost[2] else bool(left[k, 2] >= right[k, 2])
            best = (float(gains[k]), k, to_left, [*left[k].tolist(), *right[k].tolist()])
    return best


def find_edges(rows: DataFrame, columns: list[str], max_bin: int) -> list[list[float]]:
    """For each feature the upper ends of its bins but the last: quantiles, or all values where they are few."""
    asked = [i / max_bin for i in range(max_bin + 1)]
    values = lambda c: F.percentile_approx(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), asked, 100 * max_bin).alias(c)
    found = rows.agg(*[values(c) for c in columns]).first()
    return [sorted(set(found[c] or []))[:-1] for c in columns]


def binned(features: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    out = np.empty(features.shape, np.uint8)
    for j, own in enumerate(edges):
        x = features[:, j]
        out[:, j] = np.where(np.isnan(x), MISSING, np.searchsorted(np.array(own), x, "left"))
    return out


def _matrix(batch: pa.RecordBatch, columns: range) -> np.ndarray:
    return np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in columns], axis=1) if len(columns) else np.empty((batch.num_rows, 0))


def chosen(keys: np.ndarray, seed: int, share: float) -> np.ndarray:
    """A uniform choice by key, the same wherever a row is."""
    x = keys.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(11)).astype(float) / 2**53 < share


def histograms(bins: np.ndarray, nodes: np.ndarray, gradients: np.ndarray, hessians: np.ndarray, features: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(node, feature, (BINS, 3) sums of gradient, hessian and rows); rows of node -1 are left out."""
    own = nodes >= 0
    names, at = np.unique(nodes[own], return_inverse=True)
    weights = (gradients[own], hessians[own], None)
    for f in features:
        index = at * BINS + bins[own, f]
        sums = [np.bincount(index, w, len(names) * BINS).reshape(-1, BINS) for w in weights]
        for i, node in enumerate(names):
            yield int(node), f, np.stack([s[i] for s in sums], axis=1).astype(float)


@dataclass
class Booster:
    """A fitted model; only the trees up to the best round are kept."""

    columns: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]
    best_iteration: int
    #: Log loss after each round that was run, on the training rows and on the held ones.
    curve: list[tuple[float, float]]

    def margins(self, features: np.ndarray) -> np.ndarray:
        bins = binned(features, self.edges)
        return self.base + sum((t.predict(bins) for t in self.trees), np.zeros(len(bins)))

    def importances(self) -> list[tuple[str, float, int]]:
        """(feature, gain, cuts) by falling gain."""
        gains, cuts = dict.fromkeys(self.columns, 0.0), dict.fromkeys(self.columns, 0)
        for tree in self.trees:
            for f, g in zip(tree.feature, tree.gain, strict=True):
                if f >= 0:
                    gains[self.columns[f]] += g
                    cuts[self.columns[f]] += 1
        return sorted(((c, gains[c], cuts[c]) for c in self.columns), key=lambda x: (-x[1], x[0]))

    def document(self) -> dict:
        return {**asdict(self), "curve": [list(x) for x in self.curve]}

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps({k: v for k, v in self.document().items() if k != "curve"}, sort_keys=True).encode()).hexdigest()

    def save(self, spark: SparkSession, path: str) -> None:
        tables.write_json(spark, self.document(), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Booster:
        held = tables.read_json(spark, path)
        return cls(held["columns"], held["edges"], held["base"], [Tree(**t) for t in held["trees"]], held["best_iteration"], [tuple(x) for x in held["curve"]])


_ROW = "key long, label double, held boolean, bins binary, margin double"


def _binned_rows(rows: DataFrame, columns: list[str], edges: list[list[float]], base: float) -> DataFrame:
    """rows: key, label, held and the features."""
    target = to_arrow_schema(T.StructType.fromDDL(_ROW))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binned(_matrix(batch, range(3, 3 + len(columns))), edges)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(np.full(len(bins), base))], schema=target)

    return rows.select("key", "label", "held", *[F.col(c).cast("double") for c in columns]).mapInArrow(run, _ROW)


def _unpacked(batch: pa.RecordBatch, n: int, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, n)
    margins = batch.column(4).to_numpy() + sum((t.predict(bins) for t in trees), np.zeros(len(bins)))
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False).astype(bool), bins, margins


def _with_trees(rows: DataFrame, n: int, trees: list[Tree]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(_unpacked(batch, n, trees)[-1])], schema=batch.schema)

    return rows.mapInArrow(run, _ROW)


def _losses(labels: np.ndarray, margins: np.ndarray) -> float:
    return float(np.logaddexp(0, margins).sum() - (labels * margins).sum())


_CUT = "node int, feature int, gain double, cut int, missing_left boolean, sides array<double>"
_SUMS = "part int, node int, feature int, sums binary"


def _wave(rows: DataFrame, n: int, before: list[Tree], tree: Tree, wanted: set[int], features: list[int], bag: tuple[int, float], config: BoostingConfig) -> dict[int, list]:
    """For each wanted node of the growing tree its cuts, best feature first; node -1 has (loss, rows) of both splits."""
    from pyspark import TaskContext

    sums_schema, cut_schema = (to_arrow_schema(T.StructType.fromDDL(s)) for s in (_SUMS, _CUT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        seen = np.zeros(4)
        for batch in batches:
            keys, labels, held, bins, margins = _unpacked(batch, n, before)
            for k, own in enumerate((~held, held)):
                seen[2 * k : 2 * k + 2] += _losses(labels[own], margins[own]), own.sum()
            p = 1 / (1 + np.exp(-margins))
            nodes = tree.leaves(bins)
            nodes[held | ~np.isin(nodes, list(wanted))] = -1
            if bag[1] < 1:
                nodes[~chosen(keys, bag[0], bag[1])] = -1
            for node, f, h in histograms(bins, nodes, p - labels, p * (1 - p), features):
                total[node, f] = total[node, f] + h if (node, f) in total else h
        part = TaskContext.get().partitionId()
        out = [{"part": part, "node": node, "feature": f, "sums": h.tobytes()} for (node, f), h in total.items()]
        yield pa.RecordBatch.from_pylist([*out, {"part": part, "node": -1, "feature": -1, "sums": seen.tobytes()}], schema=sums_schema)

    def cuts(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # the same sum whatever arrives first
        added = np.sum([np.frombuffer(x) for x in table["sums"].to_pylist()], axis=0)
        node, f = table["node"][0].as_py(), table["feature"][0].as_py()
        if node < 0:
            row = {"node": node, "feature": f, "gain": 0.0, "cut": 0, "missing_left": False, "sides": added.tolist()}
        else:
            best = best_cut(added.reshape(BINS, 3), config)
            if best is None:
                return pa.Table.from_pylist([], schema=cut_schema)
            row = {"node": node, "feature": f, "gain": best[0], "cut": best[1], "missing_left": best[2], "sides": best[3]}
        return pa.Table.from_pylist([row], schema=cut_schema)

    found: dict[int, list] = {}
    for r in rows.mapInArrow(run, _SUMS).groupBy("node", "feature").applyInArrow(cuts, _CUT).collect():  # a row for each open node and feature
        found.setdefault(r["node"], []).append((-r["gain"], r["feature"], r["cut"], r["missing_left"], r["sides"]))
    return {node: sorted(c) for node, c in found.items()}


def _value(g: float, h: float, config: BoostingConfig) -> float:
    return -config.learning_rate * g / (h + config.lambda_l2)


def _grow(rows: DataFrame, n: int, before: list[Tree], features: list[int], bag: tuple[int, float], config: BoostingConfig) -> tuple[Tree, list]:
    """The next tree, and the losses before it."""
    tree, cuts, accepted = Tree(), {}, set()
    losses, leaves, wanted = None, [0], {0}
    while True:
        found = _wave(rows, n, before, tree, wanted, features, bag, config)
        losses = losses or found[-1][0][4]
        for node in wanted:
            cuts[node] = found.get(node, [None])[0]
            if cuts[node]:
                gain, f, cut, missing_left, s = cuts[node]
                tree.split(node, f, cut, missing_left, -gain, _value(s[0], s[1], config), _value(s[3], s[4], config))
        wanted = set()
        while len(leaves) < config.num_leaves:
            wanted = {x for x in leaves if x not in cuts}
            known = [x for x in leaves if cuts.get(x)]
            if wanted or not known:
                break
            best = min(known, key=lambda x: (cuts[x][0], x))
            accepted.add(best)
            leaves.remove(best)
            leaves += [tree.left[best], tree.right[best]]
        if not wanted:
            return tree.kept(accepted), losses
        # The same job looks at both sides of every other leaf, one of which may be the next to be cut.
        wanted |= {side for x in leaves if cuts.get(x) for side in (tree.left[x], tree.right[x]) if side not in cuts}


def train(rows: DataFrame, columns: list[str], config: BoostingConfig) -> Booster:
    """rows: key (long), label (0 or 1), held (whether the row only tells when to stop) and the features; null or NaN is missing."""
    ship_package(rows.sparkSession)
    learned = rows.where(~F.col("held"))
    n, positives = learned.agg(F.count("*"), F.sum("label")).first()
    if not n or not positives or positives == n:
        raise ValueError("training needs both labels")
    base = math.log(positives / (n - positives))
    edges = find_edges(learned, columns, config.max_bin)
    given = staged(_binned_rows(rows, columns, edges, base), "boosting-rows")
    trees: list[Tree] = []
    fresh: list[Tree] = []  # not yet in the staged sums
    curve: list[tuple[float, float]] = []
    best, best_loss = 0, math.inf
    for k in range(config.num_boost_round + 1):
        chance = np.random.default_rng([config.seed, k])
        wide = max(1, round(config.feature_fraction * len(columns)))
        features = sorted(chance.permutation(len(columns))[:wide].tolist())
        bag = (config.seed + k // config.bagging_freq, config.bagging_fraction) if config.bagging_freq else (0, 1.0)
        if k < config.num_boost_round:
            tree, losses = _grow(given, len(columns), fresh, features, bag, config)
        else:
            tree, losses = None, _wave(given, len(columns), fresh, Tree(), set(), [], bag, config)[-1][0][4]
        if k:
            held = losses[2] / losses[3] if losses[3] else math.nan
            curve.append((losses[0] / losses[1], held))
            watched = held if losses[3] else -k  # without held rows every round counts
            if watched < best_loss:
                best, best_loss = k, watched
            if k - best >= config.early_stopping_rounds:
                break
        if tree is None or len(tree.feature) == 1:
            break
        trees.append(tree)
        fresh.append(tree)
        if len(fresh) == RESTAGE:
            again = staged(_with_trees(given, len(columns), fresh), "boosting-rows")
            unstage(given)
            given, fresh = again, []
    unstage(given)
    if not curve and trees:
        best = len(trees)
    return Booster(columns, edges, base, trees[:best], best, curve)


def predict(model: Booster, pairs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` with a match probability."""
    ship_package(pairs.sparkSession)
    given = pairs.select(*keep, *[F.col(c).cast("double") for c in model.columns])
    schema = T.StructType([*given.schema.fields[: len(keep)], T.StructField("match_probability", T.DoubleType())])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = model.margins(_matrix(batch, range(len(keep), batch.num_columns)))
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns[: len(keep)], target, strict=False)], pa.array(1 / (1 + np.exp(-margins)))], schema=target)

    return given.mapInArrow(run, schema)
