"""Spark ML's boosted regression trees, fitted on blocks of binned rows.

``BlockGBTRegressor`` has the parameters, the rules and the model of ``GBTRegressor`` (squared loss, variance as impurity, splits
between the same kind of bins), and fits by other passes. Rows are dealt into bins once. Features that no row has above
their first bin together share a column of codes, and several columns one number, so a row is a few small numbers, its
weight and its residual, and a pass over many rows a few counts by number. A tree takes a pass a level: of two siblings
the smaller is counted, the other is their parent less it; leaves take their values from the level above. The last pass of
a tree brings the residuals up to date and counts the next root. Only sums by bin reach the driver.

Where a feature has more values than bins, they are cut at quantiles of all rows (``SUMMARY`` points a task), where Spark's
own fit takes a sample of rows.
"""

from __future__ import annotations

import json
import pickle
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.operators.leafwise import LEAF, Bundles, _Grower
from ratewright.storage import delete, discard, materialise, scratch_path

BLOCK = 1 << 15  # rows to a block
NUMBERS = 1 << 12  # of a number that stands for several columns of codes
SUMMARY = 2048  # values of a feature that a task's summary holds
HELD = StorageLevel(True, True, False, True)  # blocks are bytes already
RAW = "counts binary, features binary, values binary, y binary, w binary, valid boolean, summary binary"


# -- values and bins -------------------------------------------------------------------------------


def _entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all entries of sparse and dense vectors that are not 0, by row."""
    kind, _, indices, values = vectors.flatten()
    sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype("int64")
    value = values.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    feature = np.arange(len(value)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = (kind.to_numpy(zero_copy_only=False) == 0)[row]
    feature[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    on = value != 0
    return row[on], feature[on], value[on]


def _condensed(values: np.ndarray, weights: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their weights; of more than ``most``, the least, the largest and those at equal steps of weight, each
    with the weight up to it."""
    distinct, at = np.unique(values, return_inverse=True)
    total = np.bincount(at, weights, len(distinct))
    if most is None or len(distinct) <= most:
        return distinct, total
    up_to = np.cumsum(total)
    places = np.searchsorted(up_to, np.linspace(0, up_to[-1], most - 1)[1:])
    places = np.unique(np.r_[0, np.minimum(places, len(distinct) - 1), len(distinct) - 1])
    return distinct[places], np.diff(up_to[places], prepend=0.0)


@dataclass
class _Summary:
    """Of rows to learn from: values other than 0 of each feature with their weights, pairs of features that meet, weight and rows;
    blocks of all rows."""

    values: list[tuple[np.ndarray, np.ndarray]]
    met: np.ndarray
    weight: float = 0.0
    rows: int = 0
    blocks: int = 0

    def take(self, n: int, row: np.ndarray, feature: np.ndarray, value: np.ndarray, w: np.ndarray) -> None:
        on = np.zeros((n, len(self.met)), "float32")
        on[row, feature] = 1
        self.met |= on.T @ on > 0
        order = np.argsort(feature, kind="stable")
        edges = np.searchsorted(feature[order], np.arange(len(self.met) + 1))
        for f in np.flatnonzero(np.diff(edges)):
            mine = order[edges[f] : edges[f + 1]]
            old, weights = self.values[f]
            self.values[f] = _condensed(np.r_[old, value[mine]], np.r_[weights, w[row[mine]]], SUMMARY)
        self.weight += float(w.sum())
        self.rows += n

    def merge(self, other: _Summary) -> _Summary:
        pairs = zip(self.values, other.values)
        values = [_condensed(np.r_[a, b], np.r_[v, w], 4 * SUMMARY) for (a, v), (b, w) in pairs]
        return _Summary(
            values, self.met | other.met, self.weight + other.weight, self.rows + other.rows, self.blocks + other.blocks
        )

    def edges(self, max_bins: int) -> tuple[list[np.ndarray], np.ndarray]:
        """(thresholds of each feature, whether 0 is its least value): halfway between neighbours, of all values if they are
        few, else of those nearest to equal shares of the weight, by Spark's rule."""
        thresholds, from_zero = [], np.zeros(len(self.values), bool)
        most = min(max_bins, self.rows) - 1
        for f, (values, weights) in enumerate(self.values):
            rest = self.weight - weights.sum()
            if rest > 1e-9 * self.weight or not len(values):
                values, weights = _condensed(np.r_[values, 0.0], np.r_[weights, rest])
            from_zero[f] = values[0] == 0
            between = (values[1:] + values[:-1]) / 2
            if len(between) > most:
                up_to, stride, chosen, target = np.cumsum(weights), self.weight / (most + 1), [], self.weight / (most + 1)
                for i in range(len(between)):
                    if abs(up_to[i] - target) < abs(up_to[i + 1] - target):
                        chosen.append(i)
                        target += stride
                between = between[chosen]
            thresholds.append(between)
        return thresholds, from_zero


def _raw_blocks(dataset: DataFrame, features: int) -> DataFrame:
    """``dataset`` (vector, y, w, valid) as blocks of its entries, and in a last row of each task their summary."""

    def packed(held, valid):
        counts, feature, value, y, w = (np.concatenate(x) for x in zip(*held))
        arrays = counts.astype("<u2"), feature.astype("<u2"), value, y, w
        return pa.RecordBatch.from_arrays(
            [*(pa.array([a.tobytes()], pa.binary()) for a in arrays), pa.array([valid]), pa.array([None], pa.binary())],
            names=["counts", "features", "values", "y", "w", "valid", "summary"],
        )

    def batches(source):
        summary = _Summary([(np.empty(0), np.empty(0))] * features, np.zeros((features, features), bool))
        held = {False: [], True: []}
        for batch in source:
            flags = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            for valid in (False, True):
                part = batch if flags.all() == flags.any() == valid else batch.filter(pa.array(flags == valid))
                if not part.num_rows:
                    continue
                row, feature, value = _entries(part.column(0))
                if not np.isfinite(value).all():
                    raise ValueError("missing values in the features")
                y, w = (part.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
                if not valid:
                    summary.take(part.num_rows, row, feature, value, w)
                held[valid].append((np.bincount(row, minlength=part.num_rows), feature, value, y, w))
                if sum(len(x[0]) for x in held[valid]) >= BLOCK:
                    yield packed(held[valid], valid)
                    held[valid] = []
                    summary.blocks += 1
        for valid, rest in held.items():
            if rest:
                yield packed(rest, valid)
                summary.blocks += 1
        last = {"valid": pa.array([None], pa.bool_()), "summary": pa.array([pickle.dumps(summary)], pa.binary())}
        names = [name.split()[0] for name in RAW.split(", ")]
        yield pa.RecordBatch.from_arrays([last.get(n, pa.array([None], pa.binary())) for n in names], names=names)

    return dataset.mapInArrow(batches, RAW)


# -- codes -----------------------------------------------------------------------------------------


class Layout:
    """Where the bins of features are: bundles of features share a column of codes, runs of columns a number."""

    def __init__(self, edges: Sequence[np.ndarray], from_zero: np.ndarray, met: np.ndarray):
        self.edges = edges
        met = met | ~from_zero | ~from_zero[:, None]  # the codes of the others start where a row has no entry
        together = set(zip(*(x.tolist() for x in np.nonzero(np.triu(met, 1)))))
        self.bundles = Bundles.deal([len(e) + 1 for e in edges], together)
        self.sizes = self.bundles.codes
        self.numbers: list[list[int]] = []
        for c, size in enumerate(self.sizes):
            if size > 1 << 16:
                raise ValueError("at most 65,536 bins to a feature")
            if not self.numbers or np.prod([self.sizes[k] for k in self.numbers[-1]]) * size > NUMBERS:
                self.numbers.append([])
            self.numbers[-1].append(c)
        self.shapes = [tuple(self.sizes[c] for c in columns) for columns in self.numbers]
        self.where = {c: (s, k) for s, columns in enumerate(self.numbers) for k, c in enumerate(columns)}

    def encode(self, counts: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Numbers by rows."""
        codes = np.zeros((len(self.sizes), len(counts)), "int64")
        row = np.repeat(np.arange(len(counts)), counts)
        for f, (c, _, _) in self.bundles.place.items():
            if zero := int(np.searchsorted(self.edges[f], 0.0)):
                codes[c] = zero  # alone in its column
        order = np.argsort(feature, kind="stable")
        bounds = np.searchsorted(feature[order], np.arange(len(self.edges) + 1))
        for f, (c, first, _) in self.bundles.place.items():
            mine = order[bounds[f] : bounds[f + 1]]
            bins = np.searchsorted(self.edges[f], value[mine])
            if len(self.bundles.columns[c]) == 1:
                codes[c, row[mine]] = bins
            else:
                codes[c, row[mine[bins > 0]]] = first + bins[bins > 0] - 1
        out = np.empty((len(self.numbers), len(counts)), "uint16")
        for s, (columns, shape) in enumerate(zip(self.numbers, self.shapes)):
            out[s] = np.ravel_multi_index([codes[c] for c in columns], shape)
        return out

    def above(self, feature: int, bin: int) -> tuple[int, np.ndarray]:
        """(which number, of each of its values whether it is above a feature's bin)."""
        c, first, size = self.bundles.place[feature]
        s, k = self.where[c]
        code = np.indices(self.shapes[s])[k].ravel()
        return s, (code >= first + bin) & (code < first + size - 1)

    def by_column(self, sums: Sequence[np.ndarray]) -> np.ndarray:
        """Sums by number (sums x values) as sums by the codes of all columns, one after the other."""
        out = []
        for found, shape in zip(sums, self.shapes):
            whole = found.reshape(-1, *shape)
            for k in range(len(shape)):
                out.append(whole.sum(axis=tuple(a for a in range(1, whole.ndim) if a != k + 1)))
        return np.concatenate(out, axis=1)


# -- growth ----------------------------------------------------------------------------------------


@dataclass
class _Tree:
    """Nodes as parallel lists, children after their parents. ``sums``: weight, weighted residual and rows of a node."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    sums: list[np.ndarray] = field(default_factory=list)
    squares: list[float] = field(default_factory=list)
    factor: float = 1.0  # of the residuals that the tree is fitted to

    def add(self, sums: np.ndarray) -> int:
        for column, entry in zip(
            (self.feature, self.bin, self.left, self.right, self.gain, self.sums, self.squares), (LEAF, 0, LEAF, LEAF, -1.0, sums, 0.0)
        ):
            column.append(entry)
        return len(self.feature) - 1

    def mean(self, node: int) -> float:
        w, g, _ = self.sums[node]
        return float(g / w) if w > 0 else 0.0


def _reached(numbers: np.ndarray, splits: dict[int, tuple], wanted: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(node, its rows) of the wanted nodes. splits: node to (number, above, left, right)."""
    on_way = set(wanted)
    for node, (_, _, left, right) in sorted(splits.items(), reverse=True):
        if left in on_way or right in on_way:
            on_way.add(node)
    pending = [(0, None)]
    while pending:
        node, rows = pending.pop()
        if node in wanted:
            yield node, rows
            continue
        s, above, left, right = splits[node]
        high = above[numbers[s] if rows is None else numbers[s].take(rows)]
        for child, on in ((left, ~high), (right, high)):
            if child in on_way:
                pending.append((child, np.flatnonzero(on) if rows is None else rows[on]))


def _counted(layout: Layout, sums: list[np.ndarray], numbers: np.ndarray, w: np.ndarray, wr: np.ndarray, rows) -> None:
    """Add some rows of a block to weight, weighted residual and rows by number."""
    if rows is not None:
        w, wr = w.take(rows), wr.take(rows)
    for s, found in enumerate(sums):
        at = (numbers[s] if rows is None else numbers[s].take(rows)).astype(np.intp)
        for k, amount in enumerate((w, wr, None)):
            found[k] += np.bincount(at, amount, found.shape[1])


class _Booster:
    """Grows trees on an RDD of blocks (numbers, weight, residual, valid, squares by leaf of the last tree)."""

    def __init__(self, layout: Layout, depth: int, min_rows: int, parts: int):
        self.layout, self.depth, self.parts = layout, depth, parts
        self.cut = _Grower(layout.edges, layout.bundles, 1 << depth, min_rows, 0.0)

    def _sum(self, found: RDD):
        return found.treeReduce(np.add, depth=1 if self.parts <= 256 else 2)

    def _splits(self, tree: _Tree) -> dict[int, tuple]:
        return {
            node: (*self.layout.above(f, tree.bin[node]), tree.left[node], tree.right[node])
            for node, f in enumerate(tree.feature)
            if f != LEAF
        }

    def root(self, blocks: RDD, leaves: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(histogram of all rows to learn from, squares by leaf of the last tree, weight and weighted squares of the others)."""
        layout = self.layout

        def run(source):
            sums = [np.zeros((3, int(np.prod(shape)))) for shape in layout.shapes]
            squares, held = np.zeros(leaves), np.zeros(2)
            for numbers, w, r, valid, of_leaves in source:
                if valid:
                    held += w.sum(), (w * r * r).sum()
                    continue
                squares += of_leaves
                _counted(layout, sums, numbers, w, w * r, None)
            yield np.concatenate([layout.by_column(sums).ravel(), squares, held])

        found = self._sum(blocks.mapPartitions(run))
        edge = len(found) - leaves - 2
        return found[:edge].reshape(3, -1), found[edge:-2], found[-2:]

    def _histograms(self, blocks: RDD, tree: _Tree, wanted: list[int]) -> dict[int, np.ndarray]:
        layout, splits = self.layout, self._splits(tree)

        def run(source):
            sums = {node: [np.zeros((3, int(np.prod(shape)))) for shape in layout.shapes] for node in wanted}
            for numbers, w, r, valid, _ in source:
                if not valid:
                    wr = w * r
                    for node, rows in _reached(numbers, splits, set(wanted)):
                        _counted(layout, sums[node], numbers, w, wr, rows)
            yield np.stack([layout.by_column(sums[node]) for node in wanted])

        return dict(zip(wanted, self._sum(blocks.mapPartitions(run))))

    def grow(self, blocks: RDD, root: np.ndarray) -> _Tree:
        tree = _Tree()
        tree.add(root[:, self.cut.offsets[0] : self.cut.offsets[1]].sum(1))
        level = {0: root}
        for depth in range(self.depth):
            smaller = {}
            for node, histogram in level.items():
                split = self.cut.best_split(histogram)
                if split is None:
                    continue
                gain, f, at = split
                bins = self.cut.bins(histogram, [f], self.layout.bundles.place[f][2])[:, 0]
                low = bins[:, : at + 1].sum(1)
                tree.feature[node], tree.bin[node], tree.gain[node] = f, at, gain / tree.sums[node][0]
                tree.left[node], tree.right[node] = children = tree.add(low), tree.add(bins[:, at + 1 :].sum(1))
                smaller[node] = children if 2 * low[2] <= bins[2].sum() else children[::-1]
            if not smaller or depth + 1 == self.depth:
                break
            found, below = self._histograms(blocks, tree, [first for first, _ in smaller.values()]), {}
            for node, (first, second) in smaller.items():
                rest = level[node] - found[first]
                rest[:, rest[2] == 0] = 0.0
                below |= {first: found[first], second: rest}
            level = below
        return tree

    def moved(self, blocks: RDD, tree: _Tree, scale: float) -> RDD:
        """Blocks with their residuals after ``tree``, whose leaves hold ``scale`` times their means."""
        splits = self._splits(tree)
        leaves = [node for node, f in enumerate(tree.feature) if f == LEAF]
        values = {node: (k, scale * tree.mean(node)) for k, node in enumerate(leaves)}

        def run(source):
            for numbers, w, r, valid, _ in source:
                r, squares, wanted = r.copy(), np.zeros(len(leaves)), set(leaves)
                for node, rows in _reached(numbers, splits, wanted):
                    rows = slice(None) if rows is None else rows
                    k, value = values[node]
                    old = r[rows]
                    squares[k] = w[rows] @ (old * old)
                    r[rows] = old - value
                yield numbers, w, r, valid, squares

        return blocks.mapPartitions(run, preservesPartitioning=True)


# -- the estimator ---------------------------------------------------------------------------------


class BlockGBTRegressor(GBTRegressor):
    """``GBTRegressor`` for squared loss and continuous features, fitted as the module says; gives a ``GBTRegressionModel``."""

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        spark, vector = dataset.sparkSession, self.getFeaturesCol()
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        watching = self.isSet("validationIndicatorCol")
        valid = F.col(self.getValidationIndicatorCol()) if watching else F.lit(False)
        rows = dataset.select(vector, F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w"), valid.alias("valid"))
        features = _width(dataset, vector)
        raw = materialise(_raw_blocks(rows, features), "boosted_rows")
        summaries = raw.where(F.col("summary").isNotNull()).select("summary").rdd.map(lambda r: pickle.loads(r[0]))
        summary = summaries.treeReduce(_Summary.merge)
        if not summary.rows:
            raise ValueError("no rows to learn from")
        edges, from_zero = summary.edges(self.getMaxBins())
        layout = Layout(edges, from_zero, summary.met)

        def opened(r):
            counts, feature = (np.frombuffer(x, "<u2").astype("int64") for x in (r["counts"], r["features"]))
            numbers = layout.encode(counts, feature, np.frombuffer(r["values"]))
            return numbers, np.frombuffer(r["w"]), np.frombuffer(r["y"]), r["valid"], np.zeros(1)

        cores = spark.sparkContext.defaultParallelism
        parts = max(1, min(summary.blocks, cores), min(summary.blocks // 8, 2 * cores), summary.blocks // 64)
        blocks = raw.where(F.col("summary").isNull()).drop("summary").repartition(parts).rdd.map(opened)
        booster = _Booster(layout, self.getMaxDepth(), self.getMinInstancesPerNode(), parts)
        trees, best = self._boosted(spark, blocks, booster, watching)
        discard(raw)
        params = {param.name: value for param, value in self._paramMap.items()}
        return _model(spark, trees[:best], [1.0] + [self.getStepSize()] * (best - 1), layout, features, params)

    def _boosted(self, spark, blocks: RDD, booster: _Booster, watching: bool) -> tuple[list[_Tree], int]:
        """All trees that were grown, and how many of them to keep."""
        trees, least, best, stored = [], None, 0, None
        blocks = blocks.persist(HELD)
        try:
            root, _, _ = booster.root(blocks, 1)
            for m in range(self.getMaxIter()):
                tree = booster.grow(blocks, root)
                # Spark fits later trees to minus the gradient of the squared loss, twice the residual
                tree.factor = 1.0 if m == 0 else 2.0
                old, blocks = blocks, booster.moved(blocks, tree, tree.factor * (self.getStepSize() if m else 1.0))
                blocks.persist(HELD)
                if keep := (m + 1) % self.getCheckpointInterval() == 0:
                    blocks.checkpoint()  # cuts the lineage, which would grow with the trees
                root, squares, held = booster.root(blocks, tree.feature.count(LEAF))
                old.unpersist()
                if keep:
                    if stored:
                        delete(spark, stored)
                    stored = blocks.getCheckpointFile()
                _fill_squares(tree, squares)
                trees.append(tree)
                if not watching:
                    best = m + 1
                    continue
                loss = held[1] / held[0] if held[0] else 0.0
                if least is not None and least - loss < self.getValidationTol() * max(loss, 0.01):
                    break
                if least is None or loss < least:
                    least, best = loss, m + 1
        finally:
            blocks.unpersist()
            if stored:
                delete(spark, stored)
        return trees, best


def _width(dataset: DataFrame, vector: str) -> int:
    meta = dataset.schema[vector].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return meta["num_attrs"]
    first = dataset.select(vector).first()
    if first is None:
        raise ValueError("no rows to learn from")
    return first[0].size


def _fill_squares(tree: _Tree, squares: np.ndarray) -> None:
    """Weighted squares of the residuals of every node from those of the leaves."""
    leaves = iter(squares)
    for node, f in enumerate(tree.feature):
        if f == LEAF:
            tree.squares[node] = float(next(leaves))
    for node in reversed(range(len(tree.feature))):
        if tree.feature[node] != LEAF:
            tree.squares[node] = tree.squares[tree.left[node]] + tree.squares[tree.right[node]]


NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, "
    "numCategories: int>>"
)


def _model(
    spark: SparkSession, trees: Sequence[_Tree], weights: Sequence[float], layout: Layout, features: int, params: dict
) -> GBTRegressionModel:
    """The trees as Spark ML's model, by way of its saved form, which is public: nodes, trees and metadata."""
    def metadata(kind: str, uid: str, params: dict, **more) -> str:
        made = {"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "uid": uid}
        made |= {"sparkVersion": spark.version, "paramMap": {"impurity": "variance", **params}, "defaultParamMap": {}}
        return json.dumps(made | more)

    nodes, described = [], []
    for t, tree in enumerate(trees):
        for i, f in enumerate(tree.feature):
            w, g, n = map(float, tree.sums[i])
            g, squares = tree.factor * g, tree.factor**2 * tree.squares[i]
            mean = tree.factor * tree.mean(i)
            impurity = max(squares / w - mean * mean, 0.0) if w > 0 else 0.0
            gain = float(tree.factor**2 * tree.gain[i]) if f != LEAF else -1.0
            split = (-1, [], -1) if f == LEAF else (f, [float(layout.edges[f][tree.bin[i]])], -1)
            stats = [w, g, squares]
            nodes.append((t, (i, mean, impurity, stats, int(n), gain, tree.left[i], tree.right[i], split)))
        described.append((t, metadata("DecisionTreeRegressionModel", f"dtr_{t}", {}), float(weights[t])))
    path = scratch_path(spark, "boosted_model")
    whole = metadata("GBTRegressionModel", GBTRegressor().uid, params, numFeatures=features, numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    trees_schema = "treeID int, metadata string, weights double"
    spark.createDataFrame(described, trees_schema).coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{path}/data")
    return GBTRegressionModel.load(path)
