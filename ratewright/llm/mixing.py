"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow whose documents stand in a shuffled order. A document's virtual finish time is the words
of its source up to and with it, divided by the source's target; a source that is to give more than it
has starts over, at most up to its limit. In the order of that time, across all sources, documents are
taken until the total budget is used up.

Running sums are taken in two levels (groups of the shuffled order, then inside a group), so a source that
holds a third of all rows is spread over as many tasks as it fills groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.text import WORD, whole_rows
from ratewright.storage import materialise

WEIGHTS = (5, 2, 1)
LIMIT = 3  # times a source's own size that it gives at most
GROUP_ROWS = 20_000
TIMES = 100_000  # slots of virtual time


def shuffled(column: str = "doc_id", seed: str = "mix") -> Column:
    """A place in the shuffled order as 32 hex digits, from the id alone: reruns agree."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit(""))).cast("binary"))


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``sizes`` (one row per source: source, source_size) with ``target``: shares by weight of the total size,
    none above ``limit`` times its size, what is above dealt again by weight.

    The weights repeat along the sources in order of code points, NULL last. In the order of size by weight
    the full sources come first; the rest share by weight what those leave.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    given = F.array(*[F.lit(float(w)) for w in weights])
    held = sizes.withColumn("weight", F.get(given, (F.row_number().over(order) - 1) % len(weights)))
    held = held.withColumn("ceiling", limit * F.col("source_size").cast("double"))
    filling = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    left = total - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))
    held = held.withColumn("level", left / F.sum("weight").over(after))
    held = held.withColumn("open", F.col("level") * F.col("weight") < F.col("ceiling"))
    level = F.max(F.when(F.col("open"), F.col("level"))).over(Window.partitionBy())
    # the first open source has the highest level, and sets it for all that follow
    target = F.when(F.coalesce(level * F.col("weight") < F.col("ceiling"), F.lit(False)), level * F.col("weight"))
    return held.select("source", "source_size", F.coalesce(target, F.col("ceiling")).alias("target"))


def finish_times(rows: DataFrame, plan: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``rows`` (row, doc_id, source, size, place) with source_size, target and ``upto``: the words of the source
    up to and with this row in the shuffled order."""
    count = rows.count()
    digits = 1
    while 16**digits * group_rows < count:
        digits += 1
    grouped = rows.withColumn("part", F.substring("place", 1, digits))
    sums = grouped.groupBy("source", "part").agg(F.sum("size").alias("words"))
    along = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0))).drop("words")
    same = F.col("o.source").eqNullSafe(F.col("p.source"))
    offsets = offsets.alias("o").join(plan.alias("p"), same).select("o.*", "p.source_size", "p.target")
    joined = grouped.alias("g").join(
        offsets.alias("o"), F.col("g.source").eqNullSafe(F.col("o.source")) & (F.col("g.part") == F.col("o.part"))
    )
    inside = Window.partitionBy("g.source", "g.part").orderBy("place", "size", "row")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    return joined.select(
        "g.row", "g.doc_id", "g.source", "g.size", "g.place", "o.source_size", "o.target", upto.alias("upto")
    )


def queue(timed: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per document and turn: ``turn`` from 0, and ``finish``, its virtual finish time. Sources without
    words or without target have none."""
    turns = timed.where("source_size > 0 AND target > 0").withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.lit(limit - 1)))
    )
    done = (F.col("turn") * F.col("source_size") + F.col("upto")).cast("double")
    return turns.withColumn("finish", done / F.col("target"))


def taken(timed: DataFrame, limit: int = LIMIT) -> DataFrame:
    """row and ``copies``: how often the mix takes each document that it takes at all.

    The total budget is the sum of the targets. In the order of (finish, place, turn, row) a document is taken
    while the words so far stay within it. Slots of virtual time are summed first; only the slot in which the
    budget ends is put in order row by row.
    """
    per_source = timed.groupBy("source").agg(F.max("target").alias("t"))
    budget = per_source.agg(F.floor(F.sum("t") + 1e-6).alias("budget")).first()["budget"]
    line = queue(timed, limit).withColumn(
        "slot", F.least(F.floor(F.col("finish") * (TIMES // 2)), F.lit(TIMES)).cast("int")
    )
    slots = line.groupBy("slot").agg(F.sum("size").alias("words"))
    order = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    ends = slots.withColumn("total", F.sum("words").over(order))
    crossed = ends.where(F.col("total") > budget).agg(F.min_by(F.struct("slot", "total", "words"), "slot").alias("s"))
    edge = crossed.first()["s"]
    if edge is None:
        return line.groupBy("row").agg(F.count("*").cast("int").alias("copies"))
    edge, room = edge["slot"], budget - edge["total"] + edge["words"]
    last = Window.orderBy("finish", "place", "turn", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    within = (
        line.where(F.col("slot") == edge)
        .select("row", "finish", "place", "turn", "size", F.sum("size").over(last).alias("so_far"))
        .where(F.col("so_far") <= room)
    )
    chosen = line.where(F.col("slot") < edge).select("row").unionAll(within.select("row"))
    return chosen.groupBy("row").agg(F.count("*").cast("int").alias("copies"))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "source",
        word_count().alias("size"),
        shuffled().alias("place"),
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and ``taken`` (copies times size), a row per row of ``docs``.

    NULL texts have size 0; documents without words are never taken more than they count, so their ``taken`` is
    0. NULL is a source of its own. Rows that are alike in id and size share one place; which of them is
    taken makes no difference. Empty tables give no rows.
    """
    rows = materialise(_rows(docs), "mix_rows")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, limit)
    timed = materialise(finish_times(rows, plan), "mix_times")
    found = timed.join(taken(timed, limit), "row", "left")
    copies = F.coalesce("copies", F.lit(0))
    return found.select(
        "row", "doc_id", "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """The mixed stream: the rows of ``docs``, a row for each time it is taken, range-sorted by virtual finish
    time. Documents without words do not come. ``docs`` must be a stored table: its rows are numbered in two
    scans, which have to agree."""
    rows = materialise(_rows(docs), "mix_rows")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, limit)
    timed = materialise(finish_times(rows, plan), "mix_times")
    counts = timed.join(taken(timed, limit), "row").where("size > 0")
    turns = counts.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    finish = (F.col("turn") * F.col("source_size") + F.col("upto")).cast("double") / F.col("target")
    keyed = turns.select("row", finish.alias("finish"), "turn", "place")
    return whole_rows(docs).join(keyed, "row").orderBy("finish", "place", "turn", "row").select("doc.*")
