"""Gradient boosting with leaf-limited trees, grown best split first on histograms.

Rows never leave the cluster: they are binned once and written, and each pass over them brings back one
grouped aggregate of gradients and counts by node, feature and bin, a few thousand numbers. A pass
measures all nodes of the next depth that may still be part of the tree:

    Best-first growth splits a node before any other whose path holds a smaller gain. So the
    ``leaves - 1`` nodes with the largest smallest gain on their path are the tree, and only children
    of such nodes need to be measured. A tree takes as many passes as it is deep.

Histograms are summed with numpy inside tasks (``mapInArrow``) before anything is shuffled; scoring walks
flat arrays of all trees the same way. The result is a table of nodes as well, which joins can score.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.operators.forest import ForestModel
from smeltery.operators.quantiles import percentiles
from smeltery.sources.folders import written

# Parameters of the default setup.
ROUNDS = 350
LEAVES = 31
RATE = 0.05
L2 = 1.0
LEAST_ROWS = 20
BINS = 255
#: Rounds after which the rows are written again with their sums, so that no task walks many trees.
ROUNDS_PER_WRITE = 10
#: Gains are compared to so many digits: equal splits stay equal whatever order sums were added in.
GAIN_DIGITS = 6

TREE_SCHEMA = "tree int, node int, feature string, threshold double, left int, right int, value double"


@dataclass(frozen=True)
class Boosted:
    """Flat trees: a leaf is its own child. Values are added to ``base``."""

    features: tuple[str, ...]
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node; leaves have no feature, threshold and children."""
        rows = []
        ends = [*self.roots[1:], len(self.left)] if len(self.roots) else []
        for tree, (start, end) in enumerate(zip(self.roots.tolist(), ends)):
            for i in range(start, int(end)):
                if self.left[i] == i:
                    rows.append((tree, i - start, None, None, None, None, float(self.value[i])))
                else:
                    split = (self.features[self.feature[i]], float(self.threshold[i]))
                    rows.append((tree, i - start, *split, int(self.left[i]) - start, int(self.right[i]) - start, None))
        return spark.createDataFrame(rows, TREE_SCHEMA)


@dataclass
class _Node:
    parent: int
    depth: int
    sums: np.ndarray  # gradient and count
    gain: float = -math.inf
    feature: int = 0
    bin: int = 0
    smallest_gain: float = -math.inf  # on the path from the root
    children: tuple[int, int] | None = None


@dataclass
class _Tree:
    """A tree being grown; also what tasks need to place a row."""

    nodes: list[_Node] = field(default_factory=list)

    def flat(self) -> tuple[np.ndarray, ...]:
        feature = np.array([n.feature for n in self.nodes], np.int32)
        bins = np.array([n.bin for n in self.nodes], np.int32)
        pairs = [n.children or (i, i) for i, n in enumerate(self.nodes)]
        return feature, bins, np.array([p[0] for p in pairs], np.int32), np.array([p[1] for p in pairs], np.int32)

    def depth(self) -> int:
        return max((n.depth for n in self.nodes), default=0)


def _bin_edges(train: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Thresholds of each feature: one that parts missing values from all others, and its quantiles."""
    found = percentiles(train, {f: F.col(f"`{f}`") for f in features}, [i / bins for i in range(1, bins)])
    cuts = [[q for q in found[f] if q is not None and math.isfinite(q)] for f in features]
    return [np.unique(np.append(np.round(c, 6), -sys.float_info.max)) for c in cuts]


def _numbers(features: Sequence[str]) -> Column:
    """Features as one array; a missing value or NaN is below every threshold."""
    low = F.lit(-math.inf)
    return F.array(*[F.coalesce(F.nanvl(F.col(f"`{f}`").cast("double"), low), low) for f in features])


def _binned(train: DataFrame, features: Sequence[str], label: str, edges: list[np.ndarray]) -> DataFrame:
    names = [f"b{i}" for i in range(len(features))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(names))
            codes = [pa.array(np.searchsorted(e, values[:, i], "left").astype(np.int16)) for i, e in enumerate(edges)]
            yield pa.RecordBatch.from_arrays([*codes, batch.column(1), batch.column(2)], [*names, "label", "margin"])

    rows = train.select(_numbers(features).alias("x"), F.col(f"`{label}`").cast("double").alias("label"))
    base = rows.agg(F.avg("label")).first()[0]
    schema = T.StructType([T.StructField(n, T.ShortType()) for n in names]).add("label", "double").add("margin", "double")
    return written(rows.withColumn("margin", F.lit(base)).mapInArrow(run, schema), "binned")


def _histograms(rows: DataFrame, tree: _Tree, wanted: list[int], finished: list[tuple], bins: int) -> np.ndarray:
    """Sums of gradients and numbers of rows of each wanted node, by feature and bin."""
    feature, split, left, right = tree.flat()
    depth, width = tree.depth(), len(rows.columns) - 2
    slots = np.full(len(left), -1)
    slots[wanted] = np.arange(len(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(wanted) * width * bins))
        for batch in batches:
            codes = np.column_stack([batch.column(i).to_numpy() for i in range(width)]).astype(np.int32)
            margin, each = batch.column(width + 1).to_numpy().copy(), np.arange(len(codes))
            for f, s, a, b, value, steps in finished:
                at = np.zeros(len(codes), np.int32)
                for _ in range(steps):
                    at = np.where(codes[each, f[at]] <= s[at], a[at], b[at])
                margin += value[at]
            at = np.zeros(len(codes), np.int32)
            for _ in range(depth):
                at = np.where(codes[each, feature[at]] <= split[at], left[at], right[at])
            here = np.flatnonzero(slots[at] >= 0)
            flat = ((slots[at[here]][:, None] * width + np.arange(width)) * bins + codes[here]).ravel()
            gradient = np.repeat(margin[here] - batch.column(width).to_numpy()[here], width)
            sums[0] += np.bincount(flat, gradient, sums.shape[1])
            sums[1] += np.bincount(flat, minlength=sums.shape[1])
        some = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[0, some]), pa.array(sums[1, some])], ["place", "g", "n"])

    found = (
        rows.mapInArrow(run, "place bigint, g double, n double")
        .groupBy("place")
        .agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
        .toArrow()
    )
    out = np.zeros((2, len(wanted) * width * bins))
    place = found.column("place").to_numpy()
    out[0, place], out[1, place] = found.column("g").to_numpy(), found.column("n").to_numpy()
    return out.reshape(2, len(wanted), width, bins)


def _measure(node: _Node, sums: np.ndarray, l2: float, least_rows: int) -> None:
    """The best split of a node: largest gain, then first feature, then first bin."""
    node.sums = sums[:, 0].sum(axis=1)
    left = np.cumsum(sums, axis=2)
    right = node.sums[:, None, None] - left

    def worth(part: np.ndarray) -> np.ndarray:
        return part[0] ** 2 / np.maximum(part[1] + l2, 1e-12)

    allowed = (left[1] >= least_rows) & (right[1] >= least_rows)
    gain = np.where(allowed, np.round(worth(left) + worth(right) - worth(node.sums), GAIN_DIGITS), -math.inf)
    place = int(np.argmax(gain))
    if gain.flat[place] > 0:
        node.gain = float(gain.flat[place])
        node.feature, node.bin = divmod(place, gain.shape[1])


def _grown(rows: DataFrame, finished: list[tuple], leaves: int, l2: float, least_rows: int, bins: int) -> _Tree:
    tree = _Tree([_Node(-1, 0, np.zeros(2))])
    unknown = [0]
    while unknown:
        sums = _histograms(rows, tree, unknown, finished, bins + 1)
        for slot, i in enumerate(unknown):
            node = tree.nodes[i]
            _measure(node, sums[:, slot], l2, least_rows)
            above = tree.nodes[node.parent].smallest_gain if node.parent >= 0 else math.inf
            node.smallest_gain = min(above, node.gain)
        unknown = []
        for i in _best(tree, leaves):
            if tree.nodes[i].children is None:
                start = len(tree.nodes)
                tree.nodes[i].children = (start, start + 1)
                tree.nodes += [_Node(i, tree.nodes[i].depth + 1, np.zeros(2)) for _ in range(2)]
                unknown += [start, start + 1]
    return tree


def _best(tree: _Tree, leaves: int) -> list[int]:
    """The nodes that best-first growth splits; parents stand before their children."""
    able = [i for i, n in enumerate(tree.nodes) if n.smallest_gain > 0]
    return sorted(able, key=lambda i: (-tree.nodes[i].smallest_gain, tree.nodes[i].depth, i))[: leaves - 1]


def _pruned(tree: _Tree, leaves: int, rate: float, l2: float) -> tuple[_Tree, np.ndarray]:
    """The tree of the best nodes alone, and the values of its leaves."""
    split = set(_best(tree, leaves))
    out, values, places = _Tree(), [], {0: 0}
    order = [0]
    for i in order:
        node = tree.nodes[i]
        kept = _Node(-1, node.depth, node.sums, feature=node.feature, bin=node.bin)
        out.nodes.append(kept)
        values.append(0.0 if i in split else float(-rate * node.sums[0] / (node.sums[1] + l2)))
        if i in split:
            for child in node.children:
                places[child] = len(order)
                order.append(child)
            kept.children = tuple(places[c] for c in node.children)
    return out, np.array(values)


def _with_margins(rows: DataFrame, finished: list[tuple]) -> DataFrame:
    """The rows with finished trees added to their sums, written again."""
    width = len(rows.columns) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.column_stack([batch.column(i).to_numpy() for i in range(width)]).astype(np.int32)
            margin, each = batch.column(width + 1).to_numpy().copy(), np.arange(len(codes))
            for f, s, a, b, value, steps in finished:
                at = np.zeros(len(codes), np.int32)
                for _ in range(steps):
                    at = np.where(codes[each, f[at]] <= s[at], a[at], b[at])
                margin += value[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(margin)], batch.schema.names)

    return written(rows.mapInArrow(run, rows.schema), "binned")


def fit(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    rounds: int = ROUNDS,
    leaves: int = LEAVES,
    rate: float = RATE,
    l2: float = L2,
    least_rows: int = LEAST_ROWS,
    bins: int = BINS,
) -> Boosted:
    """Trees for the squared error of ``label``.

    Each tree has at most ``leaves`` leaves of at least ``least_rows`` rows. Rows without a label are left
    out; missing features are below every threshold. Without rows, or when nothing can be split, the
    model is a constant (0 without rows); growth stops at the first tree without a split.
    """
    known = train.where(F.col(f"`{label}`").isNotNull())
    edges = _bin_edges(known, features, bins)
    rows = _binned(known, features, label, edges)
    base = rows.select(F.first("margin")).first()[0]
    flat: list[tuple] = []
    roots: list[int] = []
    finished: list[tuple] = []
    deepest = 0
    for done in range(rounds if base is not None else 0):
        if finished and done % ROUNDS_PER_WRITE == 0:
            rows, finished = _with_margins(rows, finished), []
        tree, values = _pruned(_grown(rows, finished, leaves, l2, least_rows, bins), leaves, rate, l2)
        if len(tree.nodes) == 1:
            break
        finished.append((*tree.flat(), values, tree.depth()))
        deepest = max(deepest, tree.depth())
        start = len(flat)
        roots.append(start)
        for i, node in enumerate(tree.nodes):
            if node.children is None:
                flat.append((0, 0.0, start + i, start + i, values[i]))
            else:
                threshold = float(edges[node.feature][node.bin])
                flat.append((node.feature, threshold, *(start + c for c in node.children), 0.0))
    columns = list(zip(*flat)) if flat else [()] * 5
    kinds = (np.int32, np.float64, np.int32, np.int32, np.float64)
    arrays = [np.array(c, k) for c, k in zip(columns, kinds)]
    return Boosted(tuple(features), float(base or 0.0), np.array(roots, np.int32), *arrays, deepest)


def predict(df: DataFrame, model: Boosted, into: str = "prediction") -> DataFrame:
    """``df`` with the model's value; a column of that name is replaced."""
    df = df.drop(into)
    base, roots, depth, width = model.base, model.roots, model.depth, len(model.features)
    feature, threshold, left, right, value = model.feature, model.threshold, model.left, model.right, model.value
    names = [*df.columns, into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            out = np.full(batch.num_rows, base)
            each = np.arange(batch.num_rows)
            for root in roots:
                at = np.full(batch.num_rows, root, np.int32)
                for _ in range(depth):
                    at = np.where(rows[each, feature[at]] <= threshold[at], left[at], right[at])
                out += value[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out)], names)

    schema = T.StructType([*df.schema.fields]).add(into, "double")
    return df.withColumn("__x", _numbers(model.features)).mapInArrow(run, schema)


def score_by_table(
    df: DataFrame, trees: DataFrame, key: str, base: float = 0.0, weight: float = 1.0, into: str = "prediction"
) -> DataFrame:
    """``key, into``: the same value from the table of nodes, by one join for each level of the trees.

    ``into`` is ``base + weight * sum`` over all trees (a forest's mean: weight 1 / trees). ``key`` must be
    unique. The table is broadcast: its size is that of the model, trees * (2 * leaves - 1) rows.
    """
    shape = trees.agg(F.max("tree").alias("last"), F.collect_set("feature").alias("features")).first()
    if shape["last"] is None:
        return df.select(key, F.lit(base).cast("double").alias(into))
    values = F.map_from_arrays(F.array(*[F.lit(f) for f in sorted(shape["features"])]), _numbers(sorted(shape["features"])))
    state = df.select(F.col(key), values.alias("__x"), F.explode(F.sequence(F.lit(0), F.lit(shape["last"]))).alias("tree"))
    state = state.withColumn("node", F.lit(0))
    nodes = F.broadcast(trees)
    while True:
        state = written(
            state.join(nodes, ["tree", "node"]).select(
                key,
                "__x",
                "tree",
                F.when(F.col("feature").isNull(), F.col("node"))
                .when(F.col("__x")[F.col("feature")] <= F.col("threshold"), F.col("left"))
                .otherwise(F.col("right"))
                .alias("node"),
                F.col("value").alias("__value"),
            ),
            "walk",
        )
        if state.where("__value is null").isEmpty():
            break
        state = state.drop("__value")
    return state.groupBy(key).agg((F.lit(base) + F.lit(weight) * F.sum("__value")).alias(into))


def forest_table(spark: SparkSession, stage_path: str, features: Sequence[str]) -> DataFrame:
    """The trees of a saved forest or boosting stage as the same table of nodes."""
    saved = spark.read.parquet(f"{stage_path}/data")
    if "nodeData" not in saved.columns:
        return ForestModel.load(stage_path).table(features)
    names = F.array(*[F.lit(f) for f in features])
    split = F.col("nodeData.leftChild") >= 0
    return saved.select(
        F.col("treeID").cast("int").alias("tree"),
        F.col("nodeData.id").cast("int").alias("node"),
        F.when(split, names[F.col("nodeData.split.featureIndex")]).alias("feature"),
        F.when(split, F.col("nodeData.split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(split, F.col("nodeData.leftChild").cast("int")).alias("left"),
        F.when(split, F.col("nodeData.rightChild").cast("int")).alias("right"),
        F.when(~split, F.col("nodeData.prediction")).alias("value"),
    )
