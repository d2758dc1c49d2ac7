"""Boosted regression trees limited by leaves, grown best-first.

Feature values are dealt once into bins cut at quantiles. Features that no row has above their first bin together, such as
the indicators of one factor, share a column of codes, so that a row costs a byte per factor; the coded rows are written in
blocks of many rows, each column of a block one value. A tree grows from a queue of leaves by gain: the leaf whose split gains most is split next, until the tree has its leaves. Split gains come from
histograms (weight, gradient, rows) by node, feature and bin, summed per task and then by one grouped aggregate; only
the smaller child of a split is counted, its sibling is the parent less it. Where the queue meets splits whose
children are not counted yet, it goes on without them, and all of them are counted in one pass, so a tree takes
about as many passes as it is deep, and is the same as if one leaf were split at a time.

The driver holds histograms and trees, whose size depends on features, bins and leaves alone. Every few rounds the rows are
written again with their predictions so far, so no pass evaluates more than a few trees.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.operators.diagnostics import OBSERVED, PREDICTED, WEIGHT
from ratewright.operators.models import Fit, usable_rows
from ratewright.storage import materialise

REWRITE = 5  # rounds after which predictions are written with the rows
BLOCK = 1 << 16  # rows to a block
LEAF = -1


@dataclass
class Tree:
    """Nodes as parallel lists; a row goes left where its value is at most the threshold (its bin at most ``bin``)."""

    weight: float = 1.0
    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, entry in zip(
            (self.feature, self.bin, self.threshold, self.left, self.right, self.value, self.gain),
            (LEAF, 0, 0.0, LEAF, LEAF, value, 0.0),
        ):
            column.append(entry)
        return len(self.feature) - 1

    @property
    def leaves(self) -> int:
        return self.feature.count(LEAF)

    def nodes(self, high, rows: int) -> np.ndarray:
        """The leaf of every row; ``high(node, rows)`` tells which of some rows go right."""
        at = np.zeros(rows, "uint8" if len(self.feature) <= 256 else "int32")
        for node, feature in enumerate(self.feature):  # children come after their parents
            if feature != LEAF:
                here = np.flatnonzero(at == node)
                at[here] = np.where(high(node, here), self.right[node], self.left[node]).astype(at.dtype)
        return at

    def coded_nodes(self, codes: Sequence[np.ndarray], bundles: Bundles, rows: int) -> np.ndarray:
        return self.nodes(lambda node, here: bundles.above(codes, self.feature[node], self.bin[node], here), rows)

    def coded_scores(self, codes: Sequence[np.ndarray], bundles: Bundles, rows: int) -> np.ndarray:
        return (self.weight * np.asarray(self.value))[self.coded_nodes(codes, bundles, rows)]

    def scores(self, columns: Sequence[np.ndarray], rows: int) -> np.ndarray:
        at = self.nodes(lambda node, here: ~(columns[self.feature[node]][here] <= self.threshold[node]), rows)
        return (self.weight * np.asarray(self.value))[at]


@dataclass
class LeafwiseFit(Fit):
    """A fitted ensemble. ``params["base"]`` is where predictions start."""

    trees: list[Tree] = field(default_factory=list)

    def _staged(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """Predictions after each round."""
        columns = list(rows.T)
        total = np.full(len(rows), self.params["base"])
        for tree in self.trees:
            total = total + tree.scores(columns, len(rows))
            yield total

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with PREDICTED_PURE_PREMIUM added. Missing values in a feature are refused, as by the other models."""
        names, trees, base = self.features, self.trees, self.params["base"]

        def batches(source):
            for batch in source:
                rows = _values(batch, names)
                columns, total = list(rows.T), np.full(len(rows), base)
                for tree in trees:
                    total += tree.scores(columns, len(rows))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(total)], names=[*batch.schema.names, PREDICTED]
                )

        schema = df.drop(PREDICTED).schema.add(PREDICTED, "double")
        return df.drop(PREDICTED).mapInArrow(batches, schema)

    def table(self, spark: SparkSession) -> DataFrame:
        """(TREE, WEIGHT, NODE, FEATURE, BIN, THRESHOLD, LEFT, RIGHT, VALUE, GAIN), a row per node."""
        rows = [
            (i, t.weight, n, *entry)
            for i, t in enumerate(self.trees)
            for n, entry in enumerate(zip(t.feature, t.bin, t.threshold, t.left, t.right, t.value, t.gain))
        ]
        schema = "TREE int, WEIGHT double, NODE int, FEATURE int, BIN int, THRESHOLD double, LEFT int, RIGHT int, "
        return spark.createDataFrame(rows, schema + "VALUE double, GAIN double")

    def save(self, path: str) -> None:
        self.table(SparkSession.active()).coalesce(1).write.parquet(path)

    @classmethod
    def restore(cls, path: str, described: dict) -> LeafwiseFit:
        trees: dict[int, Tree] = {}
        for r in SparkSession.active().read.parquet(path).orderBy("TREE", "NODE").collect():  # bounded by the model
            tree = trees.setdefault(r["TREE"], Tree(r["WEIGHT"]))
            for column, c in zip(
                (tree.feature, tree.bin, tree.threshold, tree.left, tree.right, tree.value, tree.gain),
                ("FEATURE", "BIN", "THRESHOLD", "LEFT", "RIGHT", "VALUE", "GAIN"),
            ):
                column.append(r[c])
        return cls(None, **described, trees=list(trees.values()))

    def importance(self) -> dict[str, float]:
        """Total gain of the splits on each feature."""
        out = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature != LEAF:
                    out[self.features[feature]] += gain
        return out


def _values(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    out = np.empty((batch.num_rows, len(names)))
    for i, name in enumerate(names):
        column = batch.column(name)
        if column.null_count:
            raise ValueError(f"missing values in {name}")
        out[:, i] = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
    if np.isnan(out).any():
        raise ValueError("missing values in the features")
    return out


# -- bins ------------------------------------------------------------------------------------------


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """The upper edges of every feature's bins but the last: values at quantiles, and the least one. One pass."""
    points = [i / max_bins for i in range(1, max_bins)]
    found = df.agg(
        *[
            F.array_sort(
                F.array_distinct(
                    F.concat(
                        F.percentile_approx(F.col(f).cast("double"), points, 20 * max_bins),
                        F.array(F.min(F.col(f).cast("double"))),
                    )
                )
            ).alias(f"e{i}")
            for i, f in enumerate(features)
        ],
        *[F.max(F.col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(features)],
    ).first()
    edges = []
    for i in range(len(features)):
        cuts = np.array([x for x in found[f"e{i}"] or [] if x is not None], "float64")
        edges.append(cuts[cuts < found[f"m{i}"]] if len(cuts) else cuts)
    return edges


def _bins(batch: pa.RecordBatch, names: Sequence[str], edges: Sequence[np.ndarray]) -> np.ndarray:
    values = _values(batch, names)
    bins = np.empty(values.shape, "uint8")
    for i, cuts in enumerate(edges):
        bins[:, i] = np.searchsorted(cuts, values[:, i], side="left")
    return bins


@dataclass
class Bundles:
    """Columns of codes. Code 0: every feature of the column is in its first bin; a feature's other bins are ``size - 1``
    codes from ``first``. A feature that shares its column with none has its bins as codes."""

    columns: list[list[int]]
    place: dict[int, tuple[int, int, int]]  # feature: column, first, size

    @classmethod
    def deal(cls, sizes: Sequence[int], together: set[tuple[int, int]]) -> Bundles:
        """Every feature of more than one bin into the first column where it meets none and whose codes fit a byte."""
        columns, codes, place = [], [], {}
        for f, size in enumerate(sizes):
            if size < 2:
                continue
            for c, others in enumerate(columns):
                if codes[c] + size - 1 <= 256 and not any((other, f) in together for other in others):
                    break
            else:
                c = len(columns)
                columns.append([])
                codes.append(1)
            columns[c].append(f)
            place[f] = (c, codes[c], size)
            codes[c] += size - 1
        return cls(columns or [[]], place)

    @property
    def codes(self) -> list[int]:
        """Codes of each column."""
        return [1 + sum(self.place[f][2] - 1 for f in features) for features in self.columns]

    def encode(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.columns), len(bins)), "uint8")
        for c, features in enumerate(self.columns):
            for f in features:
                on = bins[:, f] > 0
                if out[c, on].any():
                    raise ValueError("the rows changed between two passes")
                out[c, on] = bins[on, f] + np.uint8(self.place[f][1] - 1)
        return out

    def above(self, codes: Sequence[np.ndarray], feature: int, bin: int, rows: np.ndarray) -> np.ndarray:
        """Which of some rows are above a feature's bin."""
        c, first, size = self.place[feature]
        # below the feature's codes the difference wraps around
        return codes[c][rows] - np.uint8(first + bin) <= np.uint8(size - 2 - bin)


def bundle(rows: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray]) -> Bundles:
    """Which features may share a column, from one pass that finds all pairs above their first bins in the same row."""
    names = list(features)

    def batches(source):
        met = np.zeros((len(names), len(names)), bool)
        for batch in source:
            on = (_bins(batch, names, edges) > 0).astype("float32")
            met |= on.T @ on > 0
        a, b = np.nonzero(np.triu(met, 1))
        yield pa.RecordBatch.from_arrays([pa.array(a.astype("int32")), pa.array(b.astype("int32"))], names=["a", "b"])

    pairs = rows.mapInArrow(batches, "a int, b int").distinct().toArrow()  # at most one per pair of features
    return Bundles.deal([len(e) + 1 for e in edges], set(zip(pairs["a"].to_pylist(), pairs["b"].to_pylist())))


BLOCKS = "codes binary, y binary, w binary, valid binary, p binary"


def _blocks(
    rows: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], bundles: Bundles, base: float
) -> DataFrame:
    """Blocks of rows: codes (column by column), y, w, valid, p (the prediction so far)."""
    names = list(features)

    def block(held):
        codes, y, w, valid = (np.concatenate(part, axis=-1) for part in zip(*held))
        values = codes, y, w, valid, np.full(len(y), base)
        return pa.RecordBatch.from_arrays(
            [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in values], names=["codes", "y", "w", "valid", "p"]
        )

    def batches(source):
        held, rows = [], 0
        for batch in source:
            codes = bundles.encode(_bins(batch, names, edges))
            amounts = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "valid")]
            held.append((codes, *amounts))
            rows += batch.num_rows
            if rows >= BLOCK:
                yield block(held)
                held, rows = [], 0
        if rows:
            yield block(held)

    return rows.mapInArrow(batches, BLOCKS)


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """codes, y, w, valid, p of each block."""
    for i in range(batch.num_rows):
        codes, y, w, valid, p = (
            np.frombuffer(batch.column(c)[i].as_buffer(), kind)
            for c, kind in (("codes", "uint8"), ("y", "f8"), ("w", "f8"), ("valid", "?"), ("p", "f8"))
        )
        yield codes.reshape(-1, len(y)), y, w, valid, p


def _predicted(table: DataFrame, trees: Sequence[Tree], bundles: Bundles) -> DataFrame:
    def batches(source):
        for batch in source:
            found = []
            for codes, _, _, _, p in _opened(batch):
                p = p.copy()
                for tree in trees:
                    p += tree.coded_scores(codes, bundles, len(p))
                found.append(p.tobytes())
            yield batch.set_column(batch.schema.get_field_index("p"), "p", pa.array(found, pa.binary()))

    return table.mapInArrow(batches, table.schema)


# -- histograms and growth -------------------------------------------------------------------------


@dataclass
class _Node:
    """A leaf that may be split: its histogram (weight, gradient, rows by slot), totals and best split."""

    histogram: np.ndarray
    split: tuple[float, int, int] | None = None  # gain, feature, bin


class _Grower:
    """Grows one ensemble on a table of binned rows."""

    def __init__(self, edges: Sequence[np.ndarray], bundles: Bundles, leaves: int, min_rows: int, l2: float):
        self.offsets = np.concatenate([[0], np.cumsum(bundles.codes)])
        self.bundles, self.edges, self.leaves, self.min_rows, self.l2 = bundles, edges, leaves, min_rows, l2
        self.alike = {}  # features by number of bins
        for f, (_, _, size) in bundles.place.items():
            self.alike.setdefault(size, []).append(f)

    def bins(self, histogram: np.ndarray, features: Sequence[int], size: int) -> np.ndarray:
        """(weight, gradient, rows) x feature x bin, of features with ``size`` bins."""
        out = np.empty((3, len(features), size))
        for i, f in enumerate(features):
            c, first, _ = self.bundles.place[f]
            column = histogram[:, self.offsets[c] : self.offsets[c + 1]]
            out[:, i, 1:] = column[:, first : first + size - 1]
            out[:, i, 0] = column[:, :first].sum(1) + column[:, first + size - 1 :].sum(1)
        return out

    def histograms(
        self, rows: DataFrame, recent: Sequence[Tree], tree: Tree, wanted: Sequence[int]
    ) -> tuple[dict[int, np.ndarray], tuple[float, float]]:
        """Histograms of the wanted nodes of ``tree`` over the training rows, and (weight, weighted squared error) of the
        rows held for validation."""
        offsets, bundles = self.offsets, self.bundles
        total = int(offsets[-1])
        place = {node: i for i, node in enumerate(wanted)}

        def batches(source):
            sums = np.zeros((3, len(wanted), total))
            held = np.zeros(2)
            for codes, y, w, valid, p in (block for batch in source for block in _opened(batch)):
                p = p.copy()
                for done in recent:
                    p += done.coded_scores(codes, bundles, len(p))
                if valid.any():
                    held += w[valid].sum(), (w * (y - p) ** 2)[valid].sum()
                at = tree.coded_nodes(codes, bundles, len(p))
                index = np.full(len(tree.feature), -1)
                for node, i in place.items():
                    index[node] = i
                use = np.flatnonzero((index >= 0)[at] & ~valid)
                if not len(use):
                    continue
                index, weight = index[at[use]], w[use]
                gradient = weight * (y[use] - p[use])
                for c, size in enumerate(bundles.codes):
                    slot = index * size + codes[c][use]
                    span = slice(offsets[c], offsets[c + 1])
                    for k, amount in enumerate((weight, gradient, None)):
                        found = np.bincount(slot, amount, len(wanted) * size)
                        sums[k, :, span] += found.reshape(len(wanted), size)
            node, slot = np.nonzero(sums[2])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(node, -1).astype("int32")), pa.array(np.append(slot, 0).astype("int32")),
                    *(pa.array(np.append(sums[k, node, slot], v)) for k, v in enumerate((*held, 0.0))),
                ],
                names=["node", "slot", "w", "g", "n"],
            )

        parts = rows.mapInArrow(batches, "node int, slot int, w double, g double, n double")
        summed = parts.groupBy("node", "slot").agg(*[F.sum(c).alias(c) for c in ("w", "g", "n")]).toArrow()
        node, slot = summed["node"].to_numpy(), summed["slot"].to_numpy()
        amounts = np.vstack([summed[c].to_numpy() for c in ("w", "g", "n")])
        out = {}
        for want, i in place.items():
            out[want] = np.zeros((3, total))
            mine = node == i
            out[want][:, slot[mine]] = amounts[:, mine]
        mark = np.flatnonzero(node == -1)
        return out, tuple(float(x) for x in amounts[:2, mark].sum(1))

    def best_split(self, histogram: np.ndarray) -> tuple[float, int, int] | None:
        """(gain, feature, bin) of the best split with ``min_rows`` rows on both sides; ties go to the first."""
        found = []
        for size, features in self.alike.items():
            bins = self.bins(histogram, features, size)
            bins[:, bins[2] == 0] = 0.0
            low, whole = np.cumsum(bins, axis=2)[:, :, :-1], bins.sum(axis=2)[:, :, None]
            high = whole - low
            ok = (low[2] >= self.min_rows) & (high[2] >= self.min_rows) & (low[0] > 0) & (high[0] > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = low[1] ** 2 / (low[0] + self.l2) + high[1] ** 2 / (high[0] + self.l2)
                gain = np.where(ok, gain - whole[1] ** 2 / (whole[0] + self.l2), -np.inf)
            i, at = divmod(int(gain.argmax()), size - 1)
            if gain[i, at] > 0:
                found.append((float(gain[i, at]), features[i], at))
        return max(found, key=lambda split: (split[0], -split[1]), default=None)

    def _value(self, histogram: np.ndarray) -> float:
        w, g, _ = histogram[:, self.offsets[0] : self.offsets[1]].sum(1)
        return float(g / (w + self.l2)) if w + self.l2 > 0 else 0.0

    def _select(self, counted: Tree, known: dict[int, _Node]) -> tuple[list[int], list[int]]:
        """(nodes split, in order; those of them whose children are not counted), best gain first."""
        queue, splits, pending = [], [], []
        if known[0].split:
            queue.append((-known[0].split[0], 0))
        while queue and len(splits) + 1 < self.leaves:
            _, node = heapq.heappop(queue)
            splits.append(node)
            if counted.feature[node] == LEAF:
                pending.append(node)
                continue
            for child in (counted.left[node], counted.right[node]):
                if known[child].split:
                    heapq.heappush(queue, (-known[child].split[0], child))
        return splits, pending

    def grow(self, rows: DataFrame, recent: Sequence[Tree], weight: float) -> tuple[Tree, tuple[float, float]]:
        """The next tree, and (weight, squared error) of the validation rows before it."""
        counted = Tree()  # all nodes that were counted, of which the tree takes some
        counted.add(0.0)
        found, held = self.histograms(rows, recent, counted, [0])
        known = {0: _Node(found[0], self.best_split(found[0]))}
        counted.value[0] = self._value(found[0])
        while True:
            splits, pending = self._select(counted, known)
            if not pending:
                break
            smaller = {}
            for node in pending:
                _, f, at = known[node].split
                rows_by_bin = self.bins(known[node].histogram, [f], self.bundles.place[f][2])[2, 0]
                rows_low, rows_all = rows_by_bin[: at + 1].sum(), rows_by_bin.sum()
                counted.feature[node], counted.bin[node] = f, at
                counted.left[node], counted.right[node] = counted.add(0.0), counted.add(0.0)
                children = counted.left[node], counted.right[node]
                smaller[node] = children if 2 * rows_low <= rows_all else children[::-1]
            found, _ = self.histograms(rows, recent, counted, [first for first, _ in smaller.values()])
            for node, (first, second) in smaller.items():
                rest = known[node].histogram - found[first]
                rest[:, rest[2] == 0] = 0.0
                for child, histogram in ((first, found[first]), (second, rest)):
                    known[child] = _Node(histogram, self.best_split(histogram))
                    counted.value[child] = self._value(histogram)
        tree, of = Tree(weight), {}
        of[0] = tree.add(counted.value[0])
        for node in splits:
            here = of[node]
            tree.gain[here], tree.feature[here], tree.bin[here] = known[node].split
            tree.threshold[here] = float(self.edges[tree.feature[here]][tree.bin[here]])
            for side, child in ((tree.left, counted.left[node]), (tree.right, counted.right[node])):
                of[child] = tree.add(counted.value[child])
                side[here] = of[child]
        return tree, held


def fit_leafwise(
    df: DataFrame,
    features: Sequence[str],
    rounds: int = 200,
    step: float = 0.05,
    leaves: int = 31,
    label: str = OBSERVED,
    weight: str | None = WEIGHT,
    max_bins: int = 255,
    min_rows: int = 1,
    l2: float = 0.0,
    validation: Column | None = None,
    patience: int | None = None,
) -> LeafwiseFit:
    """Boosted trees of at most ``leaves`` leaves on squared error, exposure-weighted unless ``weight=None``.

    As in ``fit_gbt`` the first tree counts whole and every later one ``step``. Rows marked by ``validation`` are not
    learned from; their loss after every round is kept in ``params["val_loss"]``. With ``patience`` the fit ends once
    that many rounds bring no better loss, and the trees after the best round are left off. Rows without a target or
    a positive weight are not learned from; missing feature values are refused.
    """
    features = list(features)
    if not 2 <= max_bins <= 256:
        raise ValueError("bins are stored in a byte: 2 to 256")
    if patience is not None and validation is None:
        raise ValueError("patience needs validation rows")
    valid = F.lit(False) if validation is None else F.coalesce(validation, F.lit(False))
    amount = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    named = [F.col(f) for f in features]
    rows = usable_rows(df, label, weight).select(
        *named, F.col(label).cast("double").alias("y"), amount.alias("w"), valid.alias("valid")
    )
    learned = rows.where("NOT valid")
    base = learned.agg((F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("m")).first()["m"]
    if base is None:
        raise ValueError("no rows to learn from")
    edges = bin_edges(learned, features, max_bins)
    bundles = bundle(rows, features, edges)
    table = materialise(_blocks(rows, features, edges, bundles, float(base)), "blocks")
    grower = _Grower(edges, bundles, leaves, min_rows, l2)
    trees: list[Tree] = []
    written, losses = 0, []

    def best() -> int:
        return int(np.argmin(losses)) + 1

    for done in range(rounds):
        if done - written >= REWRITE:
            table = materialise(_predicted(table, trees[written:done], bundles), "predicted")
            written = done
        tree, held = grower.grow(table, trees[written:], 1.0 if done == 0 else step)
        if done and held[0]:  # the loss of the trees before this one
            losses.append(held[1] / held[0])
            if patience is not None and done - best() >= patience:
                break
        trees.append(tree)
    if held[0] and len(losses) < len(trees):
        _, held = grower.histograms(table, trees[written:], _root(), [])
        losses.append(held[1] / held[0])
    if patience is not None and losses:
        trees = trees[: best()]
    params = {
        "n_estimators": len(trees), "learning_rate": step, "max_leaves": leaves, "weight": weight, "label": label,
        "base": float(base), "max_bins": max_bins,
    }
    if losses:
        params |= {"val_loss": losses, "best_round": best()}
    return LeafwiseFit(None, "leafwise", features, params, trees)


def _root() -> Tree:
    tree = Tree()
    tree.add(0.0)
    return tree


def evaluation_curve(fit: LeafwiseFit, df: DataFrame) -> DataFrame:
    """(ROUND, LOSS): weighted squared loss on ``df`` after each round, in one pass."""
    weight, label = fit.params["weight"], fit.params["label"]
    amount = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = usable_rows(df, label, weight).select(
        *[F.col(f) for f in fit.features], F.col(label).cast("double").alias("y"), amount.alias("w")
    )

    def batches(source):
        sums = np.zeros((len(fit.trees), 2))
        for batch in source:
            y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
            for i, p in enumerate(fit._staged(_values(batch, fit.features))):
                sums[i] += (w * (y - p) ** 2).sum(), w.sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(1, len(sums) + 1, dtype="int32")), pa.array(sums[:, 0]), pa.array(sums[:, 1])],
            names=["ROUND", "e", "w"],
        )

    parts = rows.mapInArrow(batches, "ROUND int, e double, w double")
    return parts.groupBy("ROUND").agg((F.sum("e") / F.sum("w")).alias("LOSS"))
