"""Order-preserving buckets: exact quantiles and running sums over a whole table without ever
sorting it in one task.

A column is cut at approximate quantiles. Every cut value gets a bucket of its own, the open gaps
between cuts get the others, so a value held by a third of all rows sits alone in its bucket and a
gap holds about ``1/cuts`` of the rows. Nothing below relies on the cuts being accurate; they only
decide how evenly the work is spread.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALUE_ROWS = 5_000  # a narrowed range with up to this many rows has its values ranked in one window
GROUP_ROWS = 1_000_000  # aimed-at size of a group
LEAST_CUTS = 64
SAMPLE_ROWS = 4_000_000


def number(c: str) -> Column:
    """The column as a double with NaN turned into NULL."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _doubles(values: Sequence[float]) -> str:
    return "array(" + ", ".join(f"double('{v!r}')" for v in values) + ")"


def row_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Rows with a value, per column; one job. Infinite values have no place between cuts and are refused."""
    infinite = [F.count_if(F.abs(number(c)) == math.inf).alias(f"i{i}") for i, c in enumerate(columns)]
    row = df.agg(*[F.count(number(c)).alias(f"n{i}") for i, c in enumerate(columns)], *infinite).first()
    if wrong := [c for i, c in enumerate(columns) if row[f"i{i}"]]:
        raise ValueError(f"infinite values in {', '.join(wrong)}")
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


def approximate_cuts(
    df: DataFrame, columns: Sequence[str], rows: int, cuts: int | None = None
) -> dict[str, list[float]]:
    """Cut values per column (ascending, a frequent value repeated), all columns in one job.

    ``rows`` decides their number, and beyond ``SAMPLE_ROWS`` also a sampling rate: the cuts only
    balance the work, so a few million rows settle them and the sketches that travel stay small
    however many input partitions there are.
    """
    cuts = cuts or max(LEAST_CUTS, rows // GROUP_ROWS)
    if rows > SAMPLE_ROWS:
        df = df.sample(SAMPLE_ROWS / rows, seed=0)
    grid = _doubles([i / cuts for i in range(1, cuts)])
    values = df.select(*[number(c).alias(f"v{i}") for i, c in enumerate(columns)])
    row = values.agg(
        *[
            F.expr(f"percentile_approx(v{i}, {grid}, {max(10_000, 10 * cuts)})").alias(f"q{i}")
            for i in range(len(columns))
        ]
    ).first()
    return {c: list(row[f"q{i}"] or []) for i, c in enumerate(columns)}


def with_buckets(df: DataFrame, edges: Mapping[str, Sequence[float]], suffix: str = "_bucket") -> DataFrame:
    """Add ``<column><suffix>``: even numbers hold exactly one cut value, odd numbers an open gap.

    Bucket numbers rise with the value. The columns must be doubles without NULL-sensitive use;
    NULL and NaN get a bucket past the last one.
    """
    usable = {c: sorted(set(e)) for c, e in edges.items()}
    cut_columns = [c for c, e in usable.items() if e]
    if cut_columns:
        df = Bucketizer(
            inputCols=cut_columns,
            outputCols=[f"{c}{suffix}_slot" for c in cut_columns],
            splitsArray=[[-math.inf, *usable[c], math.inf] for c in cut_columns],
            handleInvalid="keep",
        ).transform(df)
    numbers = {}
    for c, e in usable.items():
        if not e:
            numbers[f"{c}{suffix}"] = F.lit(1)
            continue
        slot = F.col(f"{c}{suffix}_slot").cast("int")
        lower = F.try_element_at(F.expr(_doubles(e)), F.greatest(slot, F.lit(1)))
        numbers[f"{c}{suffix}"] = (
            F.when(slot == 0, F.lit(1)).when(F.col(c) == lower, 2 * slot).otherwise(2 * slot + 1)
        )
    return df.withColumns(numbers).drop(*[f"{c}{suffix}_slot" for c in cut_columns])


# -- exact quantiles ---------------------------------------------------------------------------

BRACKET = 0.002  # cuts are set this far (in rank share) on both sides of a wanted rank


@dataclass(frozen=True)
class _Target:
    """An open range of one column's values, how many rows lie in it and below it, and the ranks
    (0-based, over the whole column) still wanted from it."""

    column: str
    low: float
    high: float
    rows: int
    below: int
    ranks: tuple[int, ...]

    def holds(self, value: Column) -> Column:
        inside = ~F.isnan(value)
        if self.low != -math.inf:
            inside &= value > F.lit(self.low)
        if self.high != math.inf:
            inside &= value < F.lit(self.high)
        return inside


def _tagged(df: DataFrame, targets: Sequence[_Target]) -> DataFrame:
    """Rows (t, v): each value of the targets' columns lying in target number ``t``. The ranges of
    one column do not overlap, so a value appears at most once."""
    by_column: dict[str, list[int]] = {}
    for i, target in enumerate(targets):
        by_column.setdefault(target.column, []).append(i)
    entries = []
    for column, members in by_column.items():
        value = F.col(column).cast("double")
        tag = F.when(targets[members[0]].holds(value), F.lit(members[0]))
        for i in members[1:]:
            tag = tag.when(targets[i].holds(value), F.lit(i))
        entries.append(F.struct(tag.alias("t"), value.alias("v")))
    return df.select(F.inline(F.array(*entries))).where("t IS NOT NULL AND v IS NOT NULL")


def _read_off(df: DataFrame, targets: Sequence[_Target], found: dict) -> None:
    """Ranks of targets small enough to be ordered in one window each."""
    per_value = _tagged(df, targets).groupBy("t", "v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("t").orderBy("v"))
    ranked = per_value.select("t", "v", (upto - F.col("n")).alias("first"), (upto - 1).alias("last"))
    wanted = F.lit(False)
    for i, target in enumerate(targets):
        for rank in target.ranks:
            wanted |= (F.col("t") == i) & F.lit(rank - target.below).between(F.col("first"), F.col("last"))
    for row in ranked.where(wanted).collect():
        target = targets[row["t"]]
        for rank in target.ranks:
            if row["first"] <= rank - target.below <= row["last"]:
                found[target.column, rank] = row["v"]


def _narrow(df: DataFrame, targets: Sequence[_Target], found: dict, bracket: float) -> list[_Target]:
    """One pass over large targets: bracket every wanted rank between approximate cuts, count the
    rows on, between and around the cuts, and return the ranges the ranks turn out to lie in."""
    tagged = _tagged(df, targets)
    largest = max(t.rows for t in targets)
    shares = {(r - t.below) / t.rows + shift for t in targets for r in t.ranks for shift in (-bracket, bracket)}
    grid = _doubles(sorted({min(1.0, max(0.0, p)) for p in shares}))
    sample = tagged.sample(SAMPLE_ROWS / largest, seed=0) if largest > SAMPLE_ROWS else tagged
    sketches = sample.groupBy("t").agg(F.expr(f"percentile_approx(v, {grid}, 10000)").alias("q"))
    cuts = sorted({v for row in sketches.collect() for v in row["q"]})
    counted = with_buckets(tagged, {"v": cuts}).groupBy("t", "v_bucket").count()
    sizes: dict[int, list[tuple[int, int]]] = {}
    for row in counted.collect():
        sizes.setdefault(row["t"], []).append((row["v_bucket"], row["count"]))

    inner = []
    for i, target in enumerate(targets):
        below = target.below
        for bucket, size in sorted(sizes[i]):
            ranks = tuple(r for r in target.ranks if below <= r < below + size)
            k = bucket // 2
            if ranks and bucket % 2 == 0:
                found.update({(target.column, r): cuts[k - 1] for r in ranks})
            elif ranks:
                low = max(target.low, cuts[k - 1] if k > 0 else -math.inf)
                high = min(target.high, cuts[k] if k < len(cuts) else math.inf)
                inner.append(_Target(target.column, low, high, size, below, ranks))
            below += size
    return inner


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    window_rows: int = VALUE_ROWS,
    bracket: float = BRACKET,
    counts: Mapping[str, int] | None = None,
) -> dict[str, list[float]]:
    """Exact linearly interpolated quantiles of several columns.

    Columns are narrowed pass by pass, each keeping only the few rows per thousand around the wanted
    ranks, until what is left of a rank has ``window_rows`` rows at most and is ordered in a window. The driver sees
    cut values and counts, never rows. A column without values gives an empty list. ``counts``
    saves a pass where the numbers of usable values (see ``row_counts``) are already known.
    """
    columns = list(dict.fromkeys(columns))
    counts = counts or row_counts(df, columns)
    targets = [
        _Target(
            c, -math.inf, math.inf, n, 0,
            tuple(sorted({f(p * (n - 1)) for p in probabilities for f in (math.floor, math.ceil)})),
        )
        for c, n in counts.items()
        if n
    ]
    found: dict[tuple[str, int], float] = {}
    while targets:
        targets = _narrow(df, targets, found, bracket)
        if small := [t for t in targets if t.rows <= window_rows]:
            _read_off(df, small, found)
        targets = [t for t in targets if t.rows > window_rows]
    result: dict[str, list[float]] = {c: [] for c in columns}
    for c in columns:
        for p in probabilities if counts[c] else ():
            position = p * (counts[c] - 1)
            below, above = found[c, math.floor(position)], found[c, math.ceil(position)]
            result[c].append(below + (above - below) * (position - math.floor(position)))
    return result


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 1000
) -> dict[str, list[float]]:
    """Observed values whose rank is within ``1/accuracy`` of the wanted one; one job for all."""
    row = df.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), list(probabilities), accuracy).alias(f"q{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return {c: list(row[f"q{i}"] or []) for i, c in enumerate(columns)}


def order_buckets(df: DataFrame, value: str, key: str, cuts: int | None = None) -> DataFrame:
    """Add ``bucket`` and ``part`` so that (bucket, part, value, key) sorts like (value, key).

    A value frequent enough to fill several cuts is split into at least as many parts, at approximate
    quantiles of the numeric tie-break ``key`` among the rows of that value alone. So no group grows
    with the number of ties, nor with where in the range of keys they lie.
    """
    rows = row_counts(df, [value])[value]
    edges = approximate_cuts(df, [value], rows, cuts)[value]
    placed = with_buckets(df, {value: edges}, "_order").withColumnRenamed(f"{value}_order", "bucket")
    repeated = Counter(edges)
    # a value filling r cuts gets the next power of two parts, so parts are at most twice the cuts
    parts = {2 * i: 1 << (repeated[e] - 1).bit_length() for i, e in enumerate(sorted(repeated), 1) if repeated[e] > 1}
    if not parts:
        return placed.withColumn("part", F.lit(0))
    tie = F.col(key).cast("double")
    sketches = []
    for size in sorted(set(parts.values())):
        held = F.when(F.col("bucket").isin([b for b, n in parts.items() if n == size]), F.col("tie"))
        sketches.append(held.alias(f"t{size}"))
    tied = placed.where(F.col("bucket").isin(list(parts))).select("bucket", tie.alias("tie"))
    tied = tied.select("bucket", *sketches)
    found = tied.groupBy("bucket").agg(
        *[
            F.expr(
                f"percentile_approx(t{size}, {_doubles([i / size for i in range(1, size)])}, {max(10_000, 10 * size)})"
            ).alias(f"q{size}")
            for size in sorted(set(parts.values()))
        ]
    )
    # at most twice as many numbers as there are cuts
    ties = [(r["bucket"], sorted(set(r[f"q{parts[r['bucket']]}"] or []))) for r in found.collect()]
    table = df.sparkSession.createDataFrame(ties, "tied_bucket int, tied_keys array<double>")
    joined = placed.join(F.broadcast(table), F.col("bucket") == F.col("tied_bucket"), "left")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(parts.values()).bit_length()))])

    def step(low: Column, by: Column) -> Column:
        inside = low + by <= F.size("tied_keys")
        return F.when(inside & (F.try_element_at("tied_keys", low + by) < tie), low + by).otherwise(low)

    part = F.when(F.col("tied_keys").isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), step))
    return joined.withColumn("part", part).drop("tied_bucket", "tied_keys")
