"""Near-duplicate vectors: a neighbour graph refined by NN-descent, cut at a cosine.

Vectors are compared within a *space*: equal label and length. Equal vectors are one node with a
number of copies, so groups of copies cost nothing.

1. *Start*: trees of random hyperplanes through the space's mean deal nodes into cells, whose number
   follows the space's size. Nodes are sorted by cell and by further planes, and each node's list takes
   the nearest of those less than ``RUN`` places away in its cell. The number of trees follows from the
   chance that two nodes at the threshold share a cell.
2. *Descent*: all nodes that a node is listed with, in either direction, are compared with each other
   (neighbours of neighbours), and lists keep the nearest found. A hub's company is dealt into chunks.
3. *Links* are listed pairs at or over the threshold; in the narrow band where single precision can
   not tell, in double precision. Lists keep the nearest only, so whatever was compared also leaves
   *bridges*: each node with the least node that links reach among those compared at once. Components of
   links and bridges are found by joins (see ``graph``).
4. *Saturated lists*, full of links, are enlarged to the node's component, which is compared with itself
   block by block in double precision; only counts leave a block.
5. *Audit* of each space, before links are used: (a) the links of a sample of its nodes with the whole
   space, which is linear in the space; (b) *probes*, planted nodes exactly at the threshold from sampled
   nodes in random directions, which judge also spaces whose true links are rare. While a space has
   found too few of either, more trees and another descent are added for it. Probes count in no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.graph import components
from smeltery.sources.folders import written

THRESHOLD = 0.98
LIST = 12
BLOCK = 256
CELL = 64
#: Nodes this many places apart in a cell's order are compared.
RUN = 128
#: Cells over this size are dealt into parts of it at random.
CROWD = 16_384
#: A pair at the threshold may miss all trees of a round with this chance.
MISSED = 0.002
PLANES = 40
#: Single precision errs by less than this for unit vectors.
BAND = 1e-5
#: Nodes of a space, on average, that are compared with it, and that have a probe; links taken of a node
#: from any block; share of either that must be found.
SAMPLED = 512
PROBES = 128
TAKEN = 4
RECALL = 0.99
#: What comparisons leave: entries of lists, connections, and pairs to be compared in double precision.
LISTED, BRIDGE, UNSURE = 0, 1, 2
FOUND = "u bigint, v bigint, sim double, kind int"
#: A space that still falls short after so many rounds is an error, not a result.
MOST_ROUNDS = 12


def _matrix(column: pa.ChunkedArray | pa.Array, kind=np.float32) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(kind, copy=False).reshape(len(column), -1)


def spaces(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``key, space, raw``: null where a vector can not be compared."""
    raw = F.col(vector).cast("array<double>")
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = F.col(label).isNotNull() & F.col(key).isNotNull() & finite & F.exists(raw, lambda x: x != 0)
    return vectors.select(
        F.col(key).cast("bigint").alias("vec_id"),
        F.when(good, F.concat_ws(":", F.col(label).cast("string"), F.size(raw).cast("string"))).alias("space"),
        F.when(good, raw).alias("raw"),
    )


def _normalised(rows: DataFrame) -> DataFrame:
    """Distinct vectors as nodes: ``node, space, raw, unit, short, first, copies``."""
    distinct = rows.where("space is not null").groupBy("space", "raw").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, shorts = [], []
            for raw in batch.column(1):
                v = raw.values.to_numpy(zero_copy_only=False)
                v = v / np.abs(v).max()  # squares of it neither overflow nor vanish
                v = v / np.sqrt((v * v).sum())
                units.append(v)
                shorts.append(v.astype(np.float32))
            arrays = [pa.array(units, pa.list_(pa.float64())), pa.array(shorts, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, "unit", "short"])

    schema = "space string, raw array<double>, first bigint, copies bigint, unit array<double>, short array<float>"
    return written(distinct.mapInArrow(run, schema).withColumn("node", F.monotonically_increasing_id()), "nodes")


def _nearest(rows: DataFrame, size: int) -> DataFrame:
    """``u, near`` (array of sim, v): the ``size`` nearest of ``u, v, sim``."""
    ordered = F.sort_array(F.collect_list(F.struct("sim", "v")), asc=False)
    # Dealt by ``u`` once, for both groupings.
    distinct = rows.repartition("u").groupBy("u", "v").agg(F.max("sim").alias("sim"))
    return distinct.groupBy("u").agg(F.slice(ordered, 1, size).alias("near"))


def _means(nodes: DataFrame) -> DataFrame:
    """``space, n, mean``"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        counts: dict[str, int] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for name in set(names):
                part = _matrix(batch.column(1).take(pa.array(np.flatnonzero(names == name))), np.float64)
                sums[name] = sums.get(name, 0) + part.sum(axis=0)
                counts[name] = counts.get(name, 0) + len(part)
        if sums:
            columns = [pa.array(list(sums)), pa.array(counts.values(), pa.int64()), pa.array(list(sums.values()), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["space", "n", "total"])

    def add(table: pa.Table) -> pa.Table:
        n = sum(table.column("n").to_pylist())
        mean = _matrix(table.column("total"), np.float64).sum(axis=0) / n
        return pa.table({"space": table.column("space")[:1], "n": [n], "mean": pa.array([mean], pa.list_(pa.float64()))})

    parts = nodes.select("space", "short").mapInArrow(run, "space string, n bigint, total array<double>")
    return written(parts.groupBy("space").applyInArrow(add, "space string, n bigint, mean array<double>"), "means")


def _sampled(nodes: DataFrame, means: DataFrame, size: int, seed: int) -> DataFrame:
    """``space, node, n, unit``: about ``size`` nodes of each space, all of a small one."""
    counted = nodes.join(means.select("space", "n"), "space")
    return counted.where(F.pmod(F.xxhash64(F.lit(seed), "node"), F.col("n")) < size).select("space", "node", "n", "unit")


def _probes(sample: DataFrame, threshold: float, seed: int) -> DataFrame:
    """``node, space, short`` of a probe for each sampled node; its number is ``-1 - node``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            probes = []
            for node, unit in zip(batch.column(1).to_pylist(), batch.column(3)):
                unit = unit.values.to_numpy(zero_copy_only=False)
                away = np.random.default_rng([seed, node]).normal(size=len(unit))
                away -= (away @ unit) * unit
                length = np.sqrt((away * away).sum())
                cosine = threshold + 4 * BAND if length > 1e-6 else 1.0
                probe = cosine * unit + np.sqrt(1 - cosine * cosine) * away / max(length, 1e-6)
                probes.append(probe.astype(np.float32))
            node = pa.array(-1 - batch.column(1).to_numpy(), pa.int64())
            yield pa.RecordBatch.from_arrays([node, batch.column(0), pa.array(probes, pa.list_(pa.float32()))], ["node", "space", "short"])

    return sample.mapInArrow(run, "node bigint, space string, short array<float>")


def trees_for(n: np.ndarray, threshold: float) -> np.ndarray:
    """Trees after which two nodes at the threshold of a space of ``n`` share a cell, but for ``MISSED``."""
    same = 1 - np.arccos(threshold) / np.pi  # side of a plane through the origin
    shared = same ** _bits(n)
    return np.maximum(3, np.ceil(np.log(MISSED) / np.log(1 - np.minimum(shared, 1 - 1e-9)))).astype(np.int64)


def _bits(n: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(np.maximum(n / CELL, 1))).astype(np.int64)


def _forest(nodes: DataFrame, means: DataFrame, size: int, threshold: float, seed: int) -> DataFrame:
    """``FOUND`` from the cells of random trees."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(3).to_numpy(zero_copy_only=False)
            bits, needed = _bits(n), trees_for(n, threshold)
            lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                part = batch.take(pa.array(own))
                centred = _matrix(part.column(2)) - _matrix(part.column(4))
                for tree in range(int(needed[own].max())):
                    some = np.flatnonzero(needed[own] > tree)
                    planes = np.random.default_rng([seed, tree, int(length)]).normal(size=(PLANES, length))
                    side = (centred[some] @ planes.T.astype(np.float32) > 0).astype(np.int64) << np.arange(PLANES)
                    used = np.arange(PLANES) < bits[own][some, None]
                    code, more = (side * used).sum(axis=1), (side * ~used).sum(axis=1)
                    arrays = [np.full(len(some), tree, np.int32), code, more]
                    columns = part.take(pa.array(some)).columns[:3]
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, arrays), *columns], ["tree", "code", "more", "node", "space", "short"]
                    )

    placed = nodes.join(means, "space").select("node", "space", "short", "n", "mean").mapInArrow(
        cells, "tree int, code bigint, more bigint, node bigint, space string, short array<float>"
    )
    cell = ["tree", "space", "code"]
    crowded = placed.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / CROWD).alias("parts")).where("parts > 1")
    part = F.coalesce(F.pmod(F.xxhash64("tree", "node"), F.col("parts")), F.lit(0))
    dealt = placed.join(crowded, cell, "left").select(
        F.xxhash64(*cell, part).alias("cell"), F.xxhash64("space").alias("place"), "more", "node", "short"
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done, more = None, 0, True
        while more:
            batch = next(batches, None)
            more = batch is not None
            if more:
                held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held is None:
                return
            node, cell, place = (held.column(c).to_numpy() for c in ("node", "cell", "place"))
            vectors, count = held.column("short").combine_chunks(), len(node)
            found = []
            while done < count and (not more or done + 2 * RUN <= count):
                around, own = slice(max(0, done - RUN), done + 2 * RUN), slice(done, done + RUN)
                found.append(_in_cells(node, cell, place, vectors, own, around, size, threshold))
                done = min(done + RUN, count)
            if found:
                yield from pa.concat_tables(found).to_batches()
            cut = max(0, done - RUN)
            held, done = held.slice(cut).combine_chunks(), done - cut

    ordered = dealt.repartition("cell").sortWithinPartitions("cell", "place", "more", "node")
    return ordered.drop("more").mapInArrow(runs, FOUND)


def _in_cells(
    node: np.ndarray, cell: np.ndarray, place: np.ndarray, vectors: pa.Array, own: slice, around: slice, size: int, threshold: float
) -> pa.Table:
    """What ``own`` rows find among those ``around`` them of their cells."""
    near = vectors[around]
    lengths = near.value_lengths().to_numpy(zero_copy_only=False)
    mine, others = np.arange(len(node))[own], np.arange(len(node))[around]
    out = []
    for length in np.unique(lengths[mine - others[0]]):  # cells of other spaces may have other lengths
        column = np.flatnonzero(lengths == length)
        row = mine[lengths[mine - others[0]] == length]
        matrix, column = _matrix(near.take(pa.array(column))), others[column]
        sims = matrix[np.searchsorted(column, row)] @ matrix.T
        same = (cell[row][:, None] == cell[column][None, :]) & (place[row][:, None] == place[column][None, :])
        out.append(_found(node[row], node[column], np.where(same, sims, -3.0), size, np.full(len(row), -2.0), threshold))
    return pa.concat_tables(out)


def _found(rows: np.ndarray, columns: np.ndarray, sims: np.ndarray, size: int, over: np.ndarray, threshold: float) -> pa.Table:
    """``FOUND``: each row's nearest columns that are nearer than ``over``, and what else links say."""
    sims = np.where(rows[:, None] == columns[None, :], -3.0, sims).astype(np.float64)
    if sims.shape[1] > 2 * size:
        best = np.argpartition(-sims, size, axis=1)[:, :size]
    else:
        best = np.argsort(-sims, axis=1, kind="stable")[:, :size]
    values = np.take_along_axis(sims, best, 1)
    row, column = np.nonzero(values > over[:, None])
    parts = [(rows[row], columns[best[row, column]], values[row, column], np.full(len(row), LISTED, np.int32))]
    real = (rows >= 0)[:, None] & (columns >= 0)[None, :] & (sims >= threshold - BAND)
    sure = real & (sims >= threshold + BAND)
    if sure.any():
        for own, peer in zip((rows, columns), _reached(rows, columns, sure)):
            moved = np.flatnonzero(peer != own)
            parts.append((own[moved], peer[moved], np.ones(len(moved)), np.full(len(moved), BRIDGE, np.int32)))
    row, column = np.nonzero(real & ~sure)
    parts.append((rows[row], columns[column], sims[row, column], np.full(len(row), UNSURE, np.int32)))
    return pa.table(dict(zip(("u", "v", "sim", "kind"), map(np.concatenate, zip(*parts)))))


def _reached(rows: np.ndarray, columns: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least node that ``linked`` reaches from each row and column."""
    some_rows, some_columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    linked = linked[np.ix_(some_rows, some_columns)]
    left, right, most = rows[some_rows], columns[some_columns], np.iinfo(np.int64).max
    before = None
    while before is None or not np.array_equal(left, before):
        before = left
        right = np.minimum(right, np.where(linked, left[:, None], most).min(axis=0))
        left = np.minimum(left, np.where(linked, right[None, :], most).min(axis=1))
    out = rows.copy(), columns.copy()
    out[0][some_rows], out[1][some_columns] = left, right
    return out


def _listed(lists: DataFrame) -> DataFrame:
    return lists.select("u", F.explode("near").alias("e")).select("u", "e.v", "e.sim")


def _descend(lists: DataFrame, nodes: DataFrame, size: int, total: int, threshold: float) -> DataFrame:
    """``FOUND`` when all nodes listed with one node have been compared."""
    pairs = _listed(lists)
    both = pairs.select(F.col("u").alias("x"), F.col("v").alias("node")).unionByName(
        pairs.select(F.col("v").alias("x"), F.col("u").alias("node"))
    ).repartition("x").distinct()
    hubs = both.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / (4 * size)).alias("chunks"))
    least = lists.select(
        F.col("u").alias("node"),
        F.when(F.size("near") < size, -2.0).otherwise(F.element_at("near", -1)["sim"]).alias("least"),
    )
    known = nodes.select("node", "short").join(least, "node", "left").fillna(-2.0, ["least"])
    company = both.join(hubs, "x").join(known, "node")
    groups = max(1, total * 3 * size // 20_000)
    company = company.select(
        "x", F.pmod(F.xxhash64("x", "node"), F.col("chunks")).alias("chunk"), "node", "short", "least"
    ).withColumn("group", F.pmod(F.xxhash64("x", "chunk"), F.lit(groups)))

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([("x", "ascending"), ("chunk", "ascending"), ("node", "ascending")])
        x, chunk, node, least = (table.column(c).to_numpy() for c in ("x", "chunk", "node", "least"))
        vectors = table.column("short").combine_chunks()
        ends = np.flatnonzero((np.diff(x) != 0) | (np.diff(chunk) != 0)) + 1
        out = []
        for low, high in zip([0, *ends], [*ends, len(x)]):
            own, matrix = node[low:high], _matrix(vectors[low:high])
            out.append(_found(own, own, matrix @ matrix.T, size, least[low:high], threshold))
        return pa.concat_tables(out)

    return company.groupBy("group").applyInArrow(meet, FOUND)


def _links(lists: DataFrame, unsure: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """``a < b`` of pairs at or over the threshold, listed or found ``unsure``; probes are below 0."""
    pairs = _listed(lists).unionByName(unsure).select(
        F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "sim"
    ).where(F.col("sim") >= threshold - BAND).groupBy("a", "b").agg(F.max("sim").alias("sim"))
    sure = pairs.where((F.col("sim") >= threshold + BAND) | (F.col("a") < 0)).select("a", "b")
    unit = nodes.select("node", "unit")
    close = (
        pairs.where((F.col("sim") < threshold + BAND) & (F.col("a") >= 0))
        .join(unit.toDF("a", "left"), "a")
        .join(unit.toDF("b", "right"), "b")
    )
    products = F.zip_with("left", "right", lambda x, y: x * y)
    cosine = F.aggregate(products, F.lit(0.0), lambda s, x: s + x)
    return sure.unionByName(close.where(cosine >= threshold).select("a", "b"))


def _sampled_links(nodes: DataFrame, means: DataFrame, sample: DataFrame, threshold: float, seed: int) -> DataFrame:
    """``space, a, b``: links of sampled nodes with the whole space, some for each node and block."""
    blocks = F.ceil(F.col("n") / (8 * BLOCK))
    asked = sample.select(
        "space", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"), "node", "unit",
        F.lit(True).alias("asked"),
    )
    rest = nodes.join(means.select("space", "n"), "space").select(
        "space", F.pmod(F.xxhash64("node"), blocks).alias("block"), "node", "unit", F.lit(False).alias("asked")
    )

    def meet(table: pa.Table) -> pa.Table:
        node, asks = table.column("node").to_numpy(), table.column("asked").to_numpy()
        vectors = _matrix(table.column("unit"), np.float64)
        linked = vectors[asks] @ vectors[~asks].T >= threshold
        row, column = np.nonzero(linked & (node[asks][:, None] != node[~asks][None, :]))
        mix = np.lexsort((np.random.default_rng(seed).random(len(row)), row))
        row, column = row[mix], column[mix]
        few = np.arange(len(row)) - np.searchsorted(row, row) < TAKEN
        a, b = node[asks][row[few]], node[~asks][column[few]]
        space = pa.array([table.column("space")[0].as_py()] * len(a), pa.string())
        return pa.table({"space": space, "a": np.minimum(a, b), "b": np.maximum(a, b)})

    found = rest.unionByName(asked).groupBy("space", "block").applyInArrow(meet, "space string, a bigint, b bigint")
    return found.distinct()


def audited(truth: DataFrame, links: DataFrame, groups: DataFrame, crowded: DataFrame, full: DataFrame) -> DataFrame:
    """``space, probes, pairs, found``: how many of the pairs ``space, a, b`` of either kind are found.

    Links inside of ``crowded`` components will be found, as will those of a probe with a ``full`` list.
    """
    whole = groups.join(crowded, "component", "left_semi")
    both = truth.join(links.withColumn("listed", F.lit(1)), ["a", "b"], "left")
    both = both.join(whole.toDF("ca", "a"), "a", "left").join(whole.toDF("cb", "b"), "b", "left")
    both = both.join(full.where("node < 0").select(F.col("node").alias("a"), F.lit(1).alias("full")), "a", "left")
    found = F.sum(F.coalesce(F.col("listed"), F.col("full"), (F.col("ca") == F.col("cb")).cast("int"), F.lit(0)))
    return both.groupBy("space", (F.col("a") < 0).alias("probes")).agg(F.count(F.lit(1)).alias("pairs"), found.alias("found"))


def _scanned(members: DataFrame, threshold: float) -> DataFrame:
    """``node, links`` of all members of a ``component``, compared block by block."""
    by = "component"
    size = members.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / (2 * BLOCK)).alias("blocks"))
    dealt = members.join(size, by).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # Each block meets each other once, and itself.
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    paired = dealt.select(by, "node", "unit", "copies", "block", other).select(
        by, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "node", "unit", "copies",
    )

    def count(table: pa.Table) -> pa.Table:
        node, copies, block = (table.column(c).to_numpy() for c in ("node", "copies", "block"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        vectors = _matrix(table.column("unit"), np.float64)
        one, two = np.flatnonzero(block == low), np.flatnonzero(block == high)
        linked = vectors[one] @ vectors[two].T >= threshold
        linked &= node[one][:, None] != node[two][None, :]
        parts = [(node[one], linked @ copies[two])]
        if low != high:
            parts.append((node[two], linked.T @ copies[one]))
        nodes, links = (np.concatenate(c) for c in zip(*parts))
        return pa.table({"node": nodes, "links": links.astype(np.int64)})

    counted = paired.groupBy(by, "low", "high").applyInArrow(count, "node bigint, links bigint")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


@dataclass(frozen=True)
class Graph:
    """``links`` a, b; ``groups`` node, component; ``crowded`` components with full lists; ``audit``."""

    links: DataFrame
    groups: DataFrame
    crowded: DataFrame
    audit: DataFrame


def neighbour_graph(nodes: DataFrame, threshold: float, size: int, seed: int) -> Graph:
    """Threshold edges of ``node, space, short, unit``, refined until the audit of every space is passed."""
    means = _means(nodes)
    sample = written(_sampled(nodes, means, SAMPLED, seed), "sample")
    chosen = sample.where(F.pmod(F.xxhash64(F.lit(seed), "node"), F.col("n")) < PROBES)
    pairs = chosen.select("space", (-1 - F.col("node")).alias("a"), F.col("node").alias("b"))
    truth = written(_sampled_links(nodes, means, sample, threshold, seed).unionByName(pairs), "truth")
    judged = written(nodes.select("node", "space", "short").unionByName(_probes(chosen, threshold, seed)), "judged")
    work, total, lists, bridges, unsure = judged, judged.count(), None, [], []
    for turn in range(MOST_ROUNDS):
        found = written(_forest(work, means, size, threshold, seed + turn), "found")
        listed = found.where(F.col("kind") == LISTED).drop("kind")
        if lists is not None:
            own = work.select(F.col("node").alias("u"))
            done, lists = lists.join(own, "u", "left_anti"), lists.join(own, "u", "left_semi")
            listed = listed.unionByName(_listed(lists))
        start = written(_nearest(listed, size), "lists")
        more = written(_descend(start, work, size, total, threshold), "found")
        refined = _nearest(_listed(start).unionByName(more.where(F.col("kind") == LISTED).drop("kind")), size)
        lists = written(refined if lists is None else refined.unionByName(done), "lists")
        for table in (found, more):
            bridges.append(table.where(F.col("kind") == BRIDGE).select(F.col("u").alias("a"), F.col("v").alias("b")))
            unsure.append(table.where(F.col("kind") == UNSURE).drop("kind"))
        links = written(_links(lists, reduce(DataFrame.unionByName, unsure), nodes, threshold), "links")
        real = links.where("a >= 0")
        groups = written(components(reduce(DataFrame.unionByName, bridges, real)), "groups")
        # Lists full of links may miss some: their components are compared as a whole.
        full = lists.where(
            (F.size("near") >= size) & (F.element_at("near", -1)["sim"] >= threshold - BAND)
        ).select(F.col("u").alias("node"))
        crowded = written(groups.join(full, "node").select("component").distinct(), "crowded")
        audit = written(audited(truth, links, groups, crowded, full), "audit")
        short = audit.where(F.col("found") < RECALL * F.col("pairs")).select("space").distinct()
        if short.isEmpty():
            return Graph(real, groups, crowded, audit)
        work = judged.join(short, "space", "left_semi")
    raise RuntimeError(f"links of some labels are not found after {MOST_ROUNDS} rounds")


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    size: int = LIST,
    seed: int = 3,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row.

    ``n_links`` counts other rows linked directly, copies included; ``component_id`` is the smallest key
    that links reach; ``kept`` says that it is the row's own. Rows with a null key or label, or a
    vector that is null, empty, zero or has null or non-finite components, have no links. Vectors of
    different lengths are never linked. Rows that repeat a key are vectors of their own. A space in
    which the audit never finds ``RECALL`` of its pairs raises an error. An empty table gives an empty
    table.
    """
    rows = spaces(vectors, key, vector, label)
    nodes = _normalised(rows)
    members = nodes.select("space", "node", "unit", "copies")
    graph = neighbour_graph(nodes, threshold, size, seed)
    links, groups = graph.links, graph.groups
    scanned = _scanned(members.join(groups, "node").join(graph.crowded, "component", "left_semi"), threshold)
    placed = nodes.join(groups, "node")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = nodes.select(F.col("node").alias("b"), "copies")
    listed = both.join(weights, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("listed"))
    names = placed.groupBy("component").agg(F.min("first").alias("name"))
    result = (
        nodes.join(groups, "node", "left")
        .join(names, "component", "left")
        .join(scanned, "node", "left")
        .join(listed, "node", "left")
        .select(
            "space", "raw",
            (F.coalesce("links", "listed", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("name", "first").alias("component_id"),
        )
    )
    own = F.coalesce("component_id", "vec_id")
    return rows.join(written(result, "results"), ["space", "raw"], "left").select(
        F.col("vec_id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"),
    )
