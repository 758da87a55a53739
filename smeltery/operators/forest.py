"""Random forests over binned rows: trees are grown by tasks, and no tree passes through the driver.

1. Features are cut at quantiles of the training rows, so a row is a *cell* of bin numbers. Rows of one cell
   and label cannot be told apart by any tree; they are counted.
2. Bootstrap: ``n`` such rows weigh Poisson(n) in a tree, which is what n rows of weight Poisson(1) weigh
   together. The draw depends on seed, cell and label alone. Each tree gets its cells with weight and sum.
3. A tree of many cells is split from the top, all trees in one pass a level, until no node holds more than
   ``CELLS_PER_GROUP`` cells. Only sums by feature and bin are shuffled for that.
4. Each such node is a group of its own, in which the rest of the tree is grown.

Labels are whole multiples of a small step, so all sums are exact: the same rows give the same trees, in
whatever order and groups they are added. Trees are a table; scoring walks them cell by cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.base import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.operators.quantiles import percentiles
from smeltery.sources.folders import written

#: Cells of one node up to which the rest of its tree is grown in one group (a few MB).
CELLS_PER_GROUP = 65_536
#: Rows of one cell and label that a task draws weights for, and cells that one group scores.
ROWS_PER_TASK = 10_000
#: Most tasks that draw weights: Spark samples 300 rows for each.
MOST_TASKS = 1_024
CELLS_PER_CHUNK = 25_000
#: Groups of trees that are scored apart.
TREE_GROUPS = 16
#: Numbers of one histogram held at a time.
HISTOGRAM = 2_000_000
#: Trees whose cells go into one batch of rows.
TREES_PER_BATCH = 25
#: Gains below this share of a node's squares are rounding.
LEAST_GAIN = 1e-12

_CELLS = "tree int, node int, code binary, weight binary, total binary"
_NODES = "tree int, node binary, feature binary, bin binary, value binary"


@dataclass(frozen=True)
class _Rule:
    width: int
    bins: int
    tried: int
    least: int
    depth: int
    seed: int
    step: float
    centre: float


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits of each number."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tried(rule: _Rule, tree: int, nodes: np.ndarray) -> np.ndarray:
    """Which features each node may be split by; decided by seed, tree and node."""
    start = _mixed(np.array([(rule.seed * 1_000_003 + tree) % 2**64], np.uint64))
    keys = _mixed(_mixed(start ^ nodes.astype(np.uint64))[:, None] + np.arange(rule.width, dtype=np.uint64))
    out = np.zeros(keys.shape, bool)
    np.put_along_axis(out, np.argsort(keys, axis=1, kind="stable")[:, : rule.tried], True, axis=1)
    return out


def _histogram(codes: np.ndarray, weight: np.ndarray, total: np.ndarray, at: np.ndarray, nodes: int, rule: _Rule) -> np.ndarray:
    """Weights and label sums by node, feature and bin."""
    size = nodes * rule.width * rule.bins
    flat = ((at[:, None] * rule.width + np.arange(rule.width)) * rule.bins + codes).ravel()
    sums = [np.bincount(flat, np.repeat(x, rule.width), size) for x in (weight, total)]
    return np.stack(sums).reshape(2, nodes, rule.width, rule.bins)


def _chosen(sums: np.ndarray, allowed: np.ndarray, rule: _Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and bin of the best split of each node, and whether there is one."""
    left = np.cumsum(sums, axis=3)
    whole = left[:, :, :1, -1:]
    left = left[:, :, :, :-1]
    right = whole - left
    able = (left[0] >= rule.least) & (right[0] >= rule.least) & allowed[:, :, None]
    base = whole[1] ** 2 / np.maximum(whole[0], 1)
    gain = left[1] ** 2 / np.maximum(left[0], 1) + right[1] ** 2 / np.maximum(right[0], 1) - base
    gain = np.where(able & (gain > LEAST_GAIN * base), gain, -math.inf).reshape(len(allowed), -1)
    if not gain.shape[1]:
        return np.zeros(len(allowed), int), np.zeros(len(allowed), int), np.zeros(len(allowed), bool)
    place = gain.argmax(axis=1)
    feature, split = np.divmod(place, rule.bins - 1)
    return feature, split, gain[np.arange(len(place)), place] > 0


def _depth(nodes: np.ndarray) -> np.ndarray:
    """Nodes are numbered as in a full tree: the root is 0, children of i are 2 i + 1 and 2 i + 2."""
    return np.frexp((nodes + 1).astype(np.float64))[1] - 1


def _grown(codes: np.ndarray, weight: np.ndarray, total: np.ndarray, tree: int, root: int, rule: _Rule) -> tuple[np.ndarray, ...]:
    """The tree below ``root``: nodes, features (-1: leaf), bins and values."""
    out = []
    nodes, at = np.array([root], np.int64), np.zeros(len(codes), np.int64)
    while len(nodes):
        mass, sums = np.bincount(at, weight, len(nodes)), np.bincount(at, total, len(nodes))
        feature, split = np.zeros(len(nodes), int), np.zeros(len(nodes), int)
        able = (mass >= 2 * rule.least) & (_depth(nodes) < rule.depth)
        many = max(1, HISTOGRAM // (rule.width * rule.bins))
        tested = np.flatnonzero(able)
        slot = np.full(len(nodes), -1)
        slot[tested] = np.arange(len(tested))
        for low in range(0, len(tested), many):
            part = tested[low : low + many]
            here = np.flatnonzero((slot[at] >= low) & (slot[at] < low + len(part)))
            found = _histogram(codes[here], weight[here], total[here], slot[at[here]] - low, len(part), rule)
            feature[part], split[part], able[part] = _chosen(found, _tried(rule, tree, nodes[part]), rule)
        value = rule.centre + rule.step * sums / np.maximum(mass, 1)
        out.append((nodes, np.where(able, feature, -1), np.where(able, split, 0), value))
        order = np.cumsum(able) - 1
        stay = able[at]
        codes, weight, total, at = codes[stay], weight[stay], total[stay], at[stay]
        right = codes[np.arange(len(codes)), feature[at]] > split[at]
        at = 2 * order[at] + right
        nodes = (2 * nodes[able][:, None] + np.array([1, 2])).ravel()
    return tuple(np.concatenate(c) for c in zip(*out))


def _unpacked(batch: pa.RecordBatch | pa.Table, width: int) -> Iterator[tuple]:
    for tree, node, code, weight, total in zip(*[batch.column(i).to_pylist() for i in range(5)]):
        cells = np.frombuffer(code, "<u2").reshape(-1, width)
        yield tree, node, cells, np.frombuffer(weight, "<f8"), np.frombuffer(total, "<f8")


def _below(codes: np.ndarray, splits: dict[int, tuple[int, int]]) -> np.ndarray:
    """The node of each cell, below all known splits of its tree."""
    at = np.zeros(len(codes), np.int64)
    for node in sorted(splits):
        here = np.flatnonzero(at == node)
        feature, split = splits[node]
        at[here] = 2 * node + 1 + (codes[here, feature] > split)
    return at


def _bins(x: Column, edges: Sequence[Sequence[float]]) -> Column:
    """The number of thresholds below each feature."""

    def bin_of(value: Column, cuts: Sequence[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda e: e < value)) if cuts else F.lit(0)

    return F.array(*[bin_of(x[i], list(cuts)) for i, cuts in enumerate(edges)])


class Forest(RandomForestRegressor):
    """Spark's random forest by its parameters, grown as this module says; weights of rows are not read."""

    def _fit(self, dataset: DataFrame) -> ForestModel:
        rows = dataset.select(
            vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")
        ).where("y is not null")
        y = F.col("y")
        seen = rows.agg(F.count("*").alias("n"), F.min("y").alias("low"), F.max("y").alias("high"), F.max(F.size("x")).alias("width")).first()
        if not seen["n"]:
            raise ValueError("no training rows")
        shares = [i / self.getMaxBins() for i in range(1, self.getMaxBins())]
        found = percentiles(rows, {f"x{i}": F.col("x")[i] for i in range(seen["width"])}, shares)
        edges = [sorted({q for q in cuts if q is not None and math.isfinite(q)}) for cuts in found.values()]
        centre, reach = (seen["low"] + seen["high"]) / 2, (seen["high"] - seen["low"]) / 2
        # Sums of twice as many labels as there are rows stay below 2 ** 52.
        step = 2.0 ** (math.frexp(max(reach, 1e-300))[1] + math.frexp(2 * seen["n"])[1] - 51)
        rule = _Rule(
            width=seen["width"],
            bins=1 + max(len(cuts) for cuts in edges),
            tried=_tried_features(self.getFeatureSubsetStrategy(), seen["width"], self.getNumTrees()),
            least=self.getMinInstancesPerNode(),
            depth=self.getMaxDepth(),
            seed=self.getSeed(),
            step=step,
            centre=centre,
        )
        label = F.round((y - F.lit(centre)) / F.lit(step)).cast("bigint")
        counted = rows.select(_bins(F.col("x"), edges).alias("code"), label.alias("label")).groupBy("code", "label").count()
        counted = written(counted, "counted")
        cells = self._bagged(counted, rule)
        nodes = _trees(cells, rule, CELLS_PER_GROUP)
        model = ForestModel(nodes, edges, self.getNumTrees())
        model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        return model

    def _bagged(self, counted: DataFrame, rule: _Rule) -> DataFrame:
        """Cells of each tree with the weights and label sums of their rows, in blocks."""
        trees, rate, drawn, seed = self.getNumTrees(), self.getSubsamplingRate(), self.getBootstrap(), rule.seed % 2**64

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                codes = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, rule.width)
                label, counts, keys = (batch.column(i).to_numpy() for i in (1, 2, 3))
                # Rows come sorted by cell.
                starts = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]).any(axis=1)))
                codes = codes[starts].astype("<u2")
                weight = np.empty((batch.num_rows, trees))
                for i, (n, key) in enumerate(zip(counts.tolist(), keys.view(np.uint64).tolist())):
                    weight[i] = np.random.Generator(np.random.Philox(key=[seed, key])).poisson(rate * n, trees) if drawn else n
                total = np.add.reduceat(weight * label[:, None], starts, axis=0)
                weight = np.add.reduceat(weight, starts, axis=0)
                for low in range(0, trees, TREES_PER_BATCH):
                    out = []
                    for tree in range(low, min(low + TREES_PER_BATCH, trees)):
                        held = np.flatnonzero(weight[:, tree])
                        out.append((tree, 0, codes[held].tobytes(), weight[held, tree].tobytes(), total[held, tree].tobytes()))
                    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "code", "weight", "total"])

        parts = max(1, min(MOST_TASKS, math.ceil(counted.count() / ROWS_PER_TASK)))
        dealt = counted.repartitionByRange(parts, "code", "label").sortWithinPartitions("code", "label")
        return written(dealt.withColumn("key", F.xxhash64("code", "label")).mapInArrow(run, _CELLS), "bagged")


def _tried_features(strategy: str, width: int, trees: int) -> int:
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": width, "onethird": math.ceil(width / 3), "sqrt": math.ceil(width**0.5), "log2": math.ceil(math.log2(max(width, 2)))}
    if strategy in named:
        return max(1, named[strategy])
    return min(width, int(strategy)) if strategy.isdigit() else max(1, math.ceil(float(strategy) * width))


def _trees(cells: DataFrame, rule: _Rule, cells_per_group: int) -> DataFrame:
    """All trees in packed rows; large nodes are split first, whatever their number of cells."""
    closed: list[tuple] = []
    splits: dict[int, dict[int, tuple[int, int]]] = {}
    width = rule.width
    sizes = F.sum(F.length("weight") / 8).alias("cells")
    large = {r["tree"]: {0} for r in cells.groupBy("tree").agg(sizes).where(F.col("cells") > cells_per_group).collect()}
    while large:

        def measured(batches: Iterator[pa.RecordBatch], large=large) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for tree, _, codes, weight, total in _unpacked(batch, width):
                    at = _below(codes, splits.get(tree, {}))
                    for node in sorted(large.get(tree, ())):
                        here = at == node
                        if here.any():
                            sums = _histogram(codes[here], weight[here], total[here], np.zeros(here.sum(), int), 1, rule)
                            held = np.bincount(codes[here].ravel() + np.tile(np.arange(width), here.sum()) * rule.bins, minlength=width * rule.bins)
                            out.append((tree, node, sums.tobytes(), held.astype("<i8").tobytes()))
                if out:
                    columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "sums", "held"])

        def chosen(key, rows):
            tree, node = key[0].as_py(), key[1].as_py()
            sums, held = np.zeros((2, 1, width, rule.bins)), np.zeros((width, rule.bins), np.int64)
            for one in rows.column("sums"):
                sums += np.frombuffer(one.as_py(), "<f8").reshape(sums.shape)
            for one in rows.column("held"):
                held += np.frombuffer(one.as_py(), "<i8").reshape(held.shape)
            feature, split, able = _chosen(sums, _tried(rule, tree, np.array([node])), rule)
            mass, label = sums[0, 0, 0].sum(), sums[1, 0, 0].sum()
            able = able[0] and _depth(np.array([node]))[0] < rule.depth
            left = int(held[feature[0], : split[0] + 1].sum())
            values = (tree, node, int(feature[0]) if able else -1, int(split[0]) if able else 0,
                      float(rule.centre + rule.step * label / max(mass, 1)), left, int(held[0].sum()) - left)
            return pa.table([pa.array([v]) for v in values], ["tree", "node", "feature", "bin", "value", "left", "right"])

        found = (
            cells.mapInArrow(measured, "tree int, node int, sums binary, held binary")
            .groupBy("tree", "node")
            .applyInArrow(chosen, "tree bigint, node bigint, feature bigint, bin bigint, value double, left bigint, right bigint")
            .collect()
        )
        large = {}
        for r in found:
            closed.append((r["tree"], r["node"], r["feature"], r["bin"], r["value"]))
            if r["feature"] >= 0:
                splits.setdefault(r["tree"], {})[r["node"]] = (r["feature"], r["bin"])
                for side, (child, size) in enumerate(((1, r["left"]), (2, r["right"]))):
                    if size > cells_per_group:
                        large.setdefault(r["tree"], set()).add(2 * r["node"] + 1 + side)
    leaves = {(tree, node) for tree, node, feature, _, _ in closed if feature < 0}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, _, codes, weight, total in _unpacked(batch, width):
                at = _below(codes, splits.get(tree, {}))
                out = []
                for node in np.unique(at).tolist():
                    if (tree, node) not in leaves:
                        here = at == node
                        out.append((tree, node, codes[here].tobytes(), weight[here].tobytes(), total[here].tobytes()))
                if out:
                    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "code", "weight", "total"])

    def grown(key, rows):
        codes, weight, total = (np.concatenate(c) for c in list(zip(*_unpacked(rows, width)))[2:])
        tree, root = key[0].as_py(), key[1].as_py()
        packed = _packed([(tree, *_grown(codes.astype(np.int64), weight, total, tree, root, rule))])
        return pa.Table.from_batches([packed])

    known = cells.sparkSession
    parts = max(1, min(4_096, 2 * known.sparkContext.defaultParallelism + len(closed)))
    open_cells = cells.mapInArrow(dealt, _CELLS) if closed else cells
    nodes = open_cells.repartition(parts, "tree", "node").groupBy("tree", "node").applyInArrow(grown, _NODES)
    if closed:
        by_tree = [(t, *(np.array(c) for c in list(zip(*[n for n in closed if n[0] == t]))[1:])) for t in sorted({n[0] for n in closed})]
        nodes = nodes.unionByName(known.createDataFrame(pa.Table.from_batches([_packed(by_tree)]), _NODES))
    return written(nodes, "trees")


def _packed(trees: list[tuple]) -> pa.RecordBatch:
    kinds = ("<i4", "<i2", "<i2", "<f8")
    rows = [(tree, *(np.asarray(c).astype(k).tobytes() for c, k in zip(parts, kinds))) for tree, *parts in trees]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))]
    return pa.RecordBatch.from_arrays(columns, ["tree", "node", "feature", "bin", "value"])


def _whole_trees(rows: pa.Table) -> Iterator[tuple]:
    """Trees in ascending order, each with its nodes in ascending order."""
    parts: dict[int, list] = {}
    for tree, *packed in zip(*[rows.column(n).to_pylist() for n in ("tree", "node", "feature", "bin", "value")]):
        parts.setdefault(tree, []).append([np.frombuffer(p, k) for p, k in zip(packed, ("<i4", "<i2", "<i2", "<f8"))])
    for tree in sorted(parts):
        node, feature, split, value = (np.concatenate(c) for c in zip(*parts[tree]))
        order = np.argsort(node)
        yield tree, node[order].astype(np.int64), feature[order].astype(np.int64), split[order].astype(np.int64), value[order]


class ForestModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """The mean of all trees; ``nodes`` is a table of packed trees."""

    def __init__(self, nodes: DataFrame | None = None, edges: Sequence[Sequence[float]] = (), trees: int = 0):
        super().__init__()
        self.nodes, self.edges, self.trees = nodes, [list(e) for e in edges], trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        coded = dataset.withColumn("__code", _bins(vector_to_array(F.col(self.getFeaturesCol())), self.edges))
        cells = written(coded.select(F.col("__code").alias("code")).distinct(), "cells")
        scored = self._scored(cells).withColumnRenamed("code", "__code").withColumnRenamed("score", self.getPredictionCol())
        return coded.join(scored, "__code").drop("__code")

    def _scored(self, cells: DataFrame) -> DataFrame:
        """``code, score``: groups of trees are walked by chunks of cells, and their sums added in a fixed order."""
        width, depth = len(self.edges), 0

        def walked(key, left, right):
            codes = left.column("code").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            each, out = np.arange(len(codes)), np.zeros(len(codes))
            for _, node, feature, split, value in _whole_trees(right):
                # Children are numbered one after the other, and so they stand.
                child = np.where(feature >= 0, np.searchsorted(node, 2 * node + 1), np.arange(len(node)))
                inner, place = feature >= 0, np.zeros(len(codes), np.int64)
                tested = np.maximum(feature, 0)
                for _ in range(int(_depth(node).max())):
                    right_side = codes[each, tested[place]] > split[place]
                    place = child[place] + (inner[place] & right_side)
                out += value[place]
            group = np.full(len(codes), key[0].as_py(), np.int32)
            return pa.table({"code": left.column("code"), "group": group, "total": out})

        chunks = max(1, math.ceil(cells.count() / CELLS_PER_CHUNK))
        parts = min(4_096, chunks * TREE_GROUPS)
        by = ("group", "chunk")
        left = cells.withColumn("chunk", F.pmod(F.xxhash64("code"), F.lit(chunks)).cast("int")).withColumn(
            "group", F.explode(F.sequence(F.lit(0), F.lit(TREE_GROUPS - 1)))
        )
        right = self.nodes.withColumn("group", F.pmod("tree", F.lit(TREE_GROUPS))).withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
        )
        sums = (
            left.repartition(parts, *by).groupBy(*by)
            .cogroup(right.repartition(parts, *by).groupBy(*by))
            .applyInArrow(walked, "code array<int>, group int, total double")
        )
        each = sums.groupBy("code").agg(*[F.max(F.when(F.col("group") == g, F.col("total"))).alias(f"t{g}") for g in range(TREE_GROUPS)])
        whole = F.lit(0.0)
        for g in range(TREE_GROUPS):
            whole = whole + F.coalesce(F.col(f"t{g}"), F.lit(0.0))
        return written(each.select("code", (whole / F.lit(float(self.trees))).alias("score")), "scores")

    def table(self, features: Sequence[str]) -> DataFrame:
        """One row per node, numbered as in a full tree; leaves have no feature, threshold and children."""
        edges, names = self.edges, list(features)

        def run(key, rows):
            for tree, node, feature, split, value in _whole_trees(rows):
                leaf = feature < 0
                cuts = [None if f < 0 else edges[f][b] for f, b in zip(feature.tolist(), split.tolist())]
                return pa.table({
                    "tree": np.full(len(node), tree, np.int32),
                    "node": node.astype(np.int32),
                    "feature": pa.array([None if f < 0 else names[f] for f in feature.tolist()], pa.string()),
                    "threshold": pa.array(cuts, pa.float64()),
                    "left": pa.array((2 * node + 1).astype(np.int32), mask=leaf),
                    "right": pa.array((2 * node + 2).astype(np.int32), mask=leaf),
                    "value": pa.array(value, mask=~leaf),
                })

        schema = "tree int, node int, feature string, threshold double, left int, right int, value double"
        return self.nodes.groupBy("tree").applyInArrow(run, schema)

    def write(self) -> _ForestWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> _ForestReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        extra = {"edges": self.model.edges, "trees": self.model.trees}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=extra)
        self.model.nodes.write.parquet(f"{path}/data")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        nodes = self.sparkSession.read.schema(_NODES).parquet(f"{path}/data")
        model = ForestModel(nodes, metadata["edges"], metadata["trees"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
