"""I-Match fingerprints.

Terms whose share of documents lies in a band make the lexicon: frequent enough not to be chance, rare
enough to tell texts apart. The lexicon is dealt at random into subsets; for each of them a document's
distinct terms are hashed together. The fingerprint lists those hashes, and two fingerprints are as
alike as the share of subsets, among those either text uses, in which they agree.

The hash of a subset is the exclusive or of its terms' hashes. It depends on the set of terms alone, as the hash
of a sorted list would, and sums up without a sort.

A text puts few terms in each of many subsets, so that an edit changes the hashes of some and leaves the others,
also where the text is long. Until they are printed, hashes are held for the subsets in use alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.text import WORD
from ratewright.storage import materialise

LOW, HIGH = 0.0005, 0.05  # shares of documents between which a term counts
SUBSETS = 1024
EMPTY = "." * 8


def terms(text: Column) -> Column:
    """Distinct words, A-Z in lower case."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.array_distinct(F.split(low, r"[\x20\x09-\x0D]+")), "")


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, subsets: int = SUBSETS) -> DataFrame:
    """term, subset, code (32 bits) of the terms found in a share of ``low`` to ``high`` of all documents.

    A term in that many documents takes up at least ``low`` of them, so there are at most (mean number of
    distinct terms of a document) / ``low``.
    """
    counted = docs.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("term"))
    counts = counted.groupBy("term").agg(F.count("*").alias("df"))
    total = docs.count()
    kept = counts.where(F.col("df").between(max(2.0, low * total), max(2.0, high * total)))
    digest = F.md5(F.col("term").cast("binary"))
    number = lambda start, length: F.conv(F.substring(digest, start, length), 16, 10).cast("long")
    return kept.select("term", (number(9, 8) % subsets).cast("int").alias("subset"), number(1, 8).alias("code"))


def cut_points(docs: DataFrame, groups: int) -> list[int]:
    """Ids that cut the documents into about equal groups in ascending order of id; one number per group."""
    if groups < 2:
        return []
    shares = [i / groups for i in range(1, groups)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 100 * groups).alias("q")).first()["q"]
    return sorted(set(found or []))


def _group(cuts: list[int]) -> Column:
    """The number of cuts at or below the id; NULL ids come before all others."""
    if not cuts:
        return F.lit(0)
    steps = F.lit(cuts) if len(cuts) < 2 else F.array(*[F.lit(c) for c in cuts])
    steps = steps if len(cuts) > 1 else F.array(F.lit(cuts[0]))
    return F.coalesce(F.size(F.filter(steps, lambda c: c <= F.col("doc_id"))), F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """row, grp, ghost, doc_id, text and ``next_text``, the text that follows in ascending order of (id, row), the
    first after the last.

    Documents are put in order in groups cut at quantiles of the id. Each group is given the first document of the
    following one as a ghost, so no group needs to look beyond itself; ghosts only lend their text.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    groups = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("grp", _group(cut_points(docs, groups)))
    key = F.struct(F.col("doc_id"), F.col("row"))
    firsts = placed.groupBy("grp").agg(F.min(key).alias("k"))  # one row per group
    along = Window.orderBy("grp")
    ends = Window.partitionBy().orderBy("grp").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lent = firsts.select(
        F.coalesce(F.lag("grp").over(along), F.last("grp").over(ends)).alias("grp"),
        F.lag("grp").over(along).isNull().alias("wraps"),
        F.col("k.row").alias("row"),
    )
    ghosts = (
        rows.join(F.broadcast(lent), "row")  # as many rows as groups
        .select("row", "doc_id", "text", "grp", F.lit(True).alias("ghost"))
    )
    everything = placed.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    order = Window.partitionBy("grp").orderBy("ghost", "doc_id", "row")
    return everything.select("*", F.lead("text").over(order).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by the first as many of the following text."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def likeness(a: Column, b: Column) -> Column:
    """The share of subsets, of those that either fingerprint uses, in which both agree; 1 if neither uses any."""
    subset = lambda c: F.transform(c, lambda x: F.shiftright(x, 32))
    used = F.size(a) + F.size(b) - F.size(F.array_intersect(subset(a), subset(b)))
    same = F.size(F.array_intersect(a, b))
    return F.when(used == 0, F.lit(1.0)).otherwise(same / used)


def printed(cells: Column, subsets: int) -> Column:
    """Eight characters a subset, from sorted cells (subset, then the 32 bits of its hash)."""
    subset = lambda at: F.coalesce(F.shiftright(F.get(cells, at), 32), F.lit(-1)).cast("int")
    code = lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    used = F.transform(cells, lambda x, i: F.concat(F.repeat(F.lit(EMPTY), subset(i) - subset(i - 1) - 1), code(x)))
    return F.concat(F.array_join(used, ""), F.repeat(F.lit(EMPTY), subsets - 1 - subset(F.size(cells) - 1)))


def fingerprints(docs: DataFrame, low: float = LOW, high: float = HIGH, subsets: int = SUBSETS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, a row per row of
    ``docs``.

    NULL texts count as empty; a text without lexicon terms has a fingerprint of dots. A document alone is
    followed by itself. Equal texts have equal fingerprints. Rows with one id stand in the order of the input.
    An empty table gives no rows. ``docs`` must be a stored table, as its rows are numbered in several scans.
    """
    known = lexicon(docs, low, high, subsets)
    known = materialise(known, "lexicon")
    paired = with_next(docs).withColumn("edited", edited(F.col("text"), F.coalesce("next_text", F.col("text"))))
    # version 0 is the text, 1 the edited one; a ghost needs only the first
    versions = F.array(
        F.struct(F.lit(0).alias("version"), terms(F.col("text")).alias("t")),
        F.struct(F.lit(1).alias("version"), F.when(~F.col("ghost"), terms(F.col("edited"))).alias("t")),
    )
    facts = (
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    held = paired.select("grp", "row", "ghost", "doc_id", *facts, F.explode(versions).alias("v"))
    held = held.select("grp", "row", "ghost", "doc_id", "n_chars", "edited_sha256", "v.version", F.explode_outer("v.t").alias("term"))
    # without its terms a document still has its row
    joined = held.join(F.broadcast(known), "term", "left")
    keys = ["grp", "row", "ghost", "doc_id", "n_chars", "edited_sha256"]
    codes = joined.groupBy(*keys, "version", "subset").agg(F.expr("bit_xor(code)").alias("code"))
    codes = codes.withColumn("cell", F.expr("shiftleft(cast(subset AS long), 32) + code"))
    cells = lambda v: F.sort_array(F.collect_list(F.when(F.col("version") == v, F.col("cell"))))
    listed = codes.groupBy(*keys).agg(cells(0).alias("c0"), cells(1).alias("c1"))

    order = Window.partitionBy("grp").orderBy("ghost", "doc_id", "row")
    done = listed.withColumn("c2", F.coalesce(F.lead("c0").over(order), F.col("c0"))).where("NOT ghost")
    return done.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(F.col("c0"), subsets).alias("fingerprint"),
        printed(F.col("c1"), subsets).alias("edited_fingerprint"),
        likeness(F.col("c0"), F.col("c1")).alias("near_edited"),
        likeness(F.col("c0"), F.col("c2")).alias("near_next"),
    )
