"""XML policy and claim feeds in and out, and normalisation of the raw source columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.functions.columns import relabel, strip_quotes
from ratewright.storage import materialise

# Names and code tables of the public source data and of the feeds.
POLICY_COLUMNS = {
    "IDpol": "POLICY_ID",
    "ClaimNb": "CLAIM_COUNT",
    "Exposure": "EXPOSURE",
    "Area": "TERRITORY_CODE",
    "VehPower": "CONSTRUCTION_QUALITY",
    "VehAge": "PROPERTY_AGE",
    "DrivAge": "POLICYHOLDER_AGE",
    "BonusMalus": "LOSS_HISTORY_SCORE",
    "VehBrand": "CONSTRUCTION_TYPE",
    "VehGas": "OCCUPANCY_TYPE",
    "Density": "POPULATION_DENSITY",
    "Region": "REGION_CODE",
}
CLAIM_COLUMNS = {"IDpol": "POLICY_ID", "ClaimAmount": "CLAIM_AMOUNT"}
CONSTRUCTION_TYPES = {
    "B1": "Frame",
    "B2": "Masonry",
    "B3": "Superior Masonry",
    "B4": "Non-Combustible",
    "B5": "Masonry Non-Combustible",
    "B6": "Modified Fire Resistive",
    "B10": "Fire Resistive",
    "B11": "Log",
    "B12": "Superior Frame",
    "B13": "Manufactured Home",
    "B14": "Mixed Construction",
}
OCCUPANCY_TYPES = {"Regular": "Owner-Occupied", "Diesel": "Tenant-Occupied"}
# (column, path of the element, type)
POLICY_FIELDS = (
    ("POLICY_ID", "PolicyId", "bigint"),
    ("EXPOSURE", "Exposure", "double"),
    ("POLICYHOLDER_AGE", "PolicyholderAge", "int"),
    ("LOSS_HISTORY_SCORE", "LossHistoryScore", "double"),
    ("POPULATION_DENSITY", "PopulationDensity", "double"),
    ("REGION_CODE", "RegionCode", "string"),
    ("TERRITORY_CODE", "Risk.TerritoryCode", "string"),
    ("CONSTRUCTION_TYPE", "Risk.ConstructionType", "string"),
    ("CONSTRUCTION_QUALITY", "Risk.ConstructionQuality", "int"),
    ("PROPERTY_AGE", "Risk.PropertyAge", "int"),
    ("OCCUPANCY_TYPE", "Risk.OccupancyType", "string"),
    ("CLAIM_COUNT", "Claims.ClaimCount", "int"),
)
CLAIM_FIELDS = (("POLICY_ID", "PolicyId", "bigint"), ("CLAIM_AMOUNT", "ClaimAmount", "double"))
FEED_DECIMALS = {"EXPOSURE": 6, "LOSS_HISTORY_SCORE": 4, "POPULATION_DENSITY": 4, "CLAIM_AMOUNT": 2}

POLICY_FEED = ("PolicyFeed", "Policy", POLICY_FIELDS)
CLAIM_FEED = ("ClaimFeed", "Claim", CLAIM_FIELDS)
POLICY_PATTERN = "*policy_freq*"
CLAIM_PATTERN = "*policy_sev*"


# -- source normalisation ----------------------------------------------------------------------


def normalise_policies(raw: DataFrame) -> DataFrame:
    """Source columns renamed, string codes unquoted, brand and fuel codes labelled, types set.

    A code outside its table, or a number that does not parse, becomes NULL.
    """
    named = raw.withColumnsRenamed(POLICY_COLUMNS)
    kinds = {name: kind for name, _, kind in POLICY_FIELDS}
    expressions: dict[str, Column] = {}
    for name, kind in kinds.items():
        plain = strip_quotes(name)
        expressions[name] = plain if kind == "string" else F.col(name).try_cast(kind)
    expressions["CONSTRUCTION_TYPE"] = relabel(expressions["CONSTRUCTION_TYPE"], CONSTRUCTION_TYPES)
    expressions["OCCUPANCY_TYPE"] = relabel(expressions["OCCUPANCY_TYPE"], OCCUPANCY_TYPES)
    return named.select(*[e.alias(name) for name, e in expressions.items()])


def normalise_claims(raw: DataFrame) -> DataFrame:
    named = raw.withColumnsRenamed(CLAIM_COLUMNS)
    return named.select(*[F.col(name).try_cast(kind).alias(name) for name, _, kind in CLAIM_FIELDS])


# -- writing -----------------------------------------------------------------------------------


def _element(fields, values: Mapping[str, Column]) -> list[Column]:
    top, nested = [], {}
    for column, path, _ in fields:
        *parents, leaf = path.split(".")
        if parents:
            if parents[0] not in nested:
                nested[parents[0]] = []
                top.append(parents[0])
            nested[parents[0]].append(values[column].alias(leaf))
        else:
            top.append(values[column].alias(leaf))
    return [F.struct(*nested[t]).alias(t) if isinstance(t, str) else t for t in top]


def feed_rows(df: DataFrame, feed) -> DataFrame:
    """Table rows in the element structure of a feed, with the feed's rounding."""
    _, _, fields = feed
    values = {
        c: F.round(c, FEED_DECIMALS[c]) if c in FEED_DECIMALS else F.col(c) for c, _, _ in fields
    }
    return df.select(*_element(fields, values))


def _write(df: DataFrame, path: str, feed, compression: str, rows_per_file: int) -> None:
    write_elements(feed_rows(df, feed), path, feed, compression, rows_per_file)


def write_elements(rows: DataFrame, path: str, feed, compression: str = "gzip", rows_per_file: int = 250_000) -> None:
    """Rows that have the element structure already, and maybe elements the feed's fields do not list."""
    root, row, _ = feed
    (
        rows.write.format("xml")
        .mode("overwrite")
        .option("rootTag", root)
        .option("rowTag", row)
        .option("compression", compression)
        .option("declaration", "")
        .option("maxRecordsPerFile", rows_per_file)
        .save(path)
    )


def write_policy_feed(df: DataFrame, path: str, compression: str = "gzip", rows_per_file: int = 250_000) -> None:
    """A directory of XML part files, each a complete ``<PolicyFeed>``. Missing values are left
    out as elements. Gzip parts cannot be split on reading, so ``rows_per_file`` bounds them."""
    _write(df, path, POLICY_FEED, compression, rows_per_file)


def write_claim_feed(df: DataFrame, path: str, compression: str = "gzip", rows_per_file: int = 1_000_000) -> None:
    _write(df, path, CLAIM_FEED, compression, rows_per_file)


def write_predictions_feed(df: DataFrame, path: str, compression: str = "gzip", rows_per_file: int = 1_000_000) -> None:
    """Scored rows as ``<Predictions><Prediction>`` elements, one element per column."""
    (
        df.write.format("xml")
        .mode("overwrite")
        .option("rootTag", "Predictions")
        .option("rowTag", "Prediction")
        .option("compression", compression)
        .option("declaration", "")
        .option("maxRecordsPerFile", rows_per_file)
        .save(path)
    )


def read_predictions_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = spark.read.format("xml").option("rowTag", "Prediction").schema(text).load(path)
    return rows.select(
        *[
            (F.col(f.name) if isinstance(f.dataType, T.StringType) else F.trim(f.name).try_cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


# -- reading -----------------------------------------------------------------------------------


def _leaf_schema(fields) -> T.StructType:
    """Every element as text: one unreadable number must not blank its neighbours."""
    schema, nested = T.StructType(), {}
    for _, path, _ in fields:
        *parents, leaf = path.split(".")
        if parents:
            if parents[0] not in nested:
                nested[parents[0]] = T.StructType()
                schema.add(parents[0], nested[parents[0]])
            nested[parents[0]].add(leaf, T.StringType())
        else:
            schema.add(leaf, T.StringType())
    return schema


def _scan(spark: SparkSession, path: str, feed, pattern: str | None) -> DataFrame:
    _, row, fields = feed
    location = f"{path.rstrip('/')}/{pattern}" if pattern else path
    return spark.read.format("xml").option("rowTag", row).schema(_leaf_schema(fields)).load(location)


def _typed(fields) -> list[Column]:
    return [
        (F.col(path) if kind == "string" else F.trim(F.col(path)).try_cast(kind)).alias(column)
        for column, path, kind in fields
    ]


def read_policy_feed(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Typed policies, one row per ``<Policy>``. Compressed files are read by extension.

    ``pattern`` selects by name inside an inbound directory shared with other feeds, for instance
    ``POLICY_PATTERN``; it matches single files and directories of part files alike.
    """
    return _scan(spark, path, POLICY_FEED, pattern).select(*_typed(POLICY_FIELDS))


def read_claim_feed(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    return _scan(spark, path, CLAIM_FEED, pattern).select(*_typed(CLAIM_FIELDS))


def feed_quality(spark: SparkSession, path: str, feed=POLICY_FEED, pattern: str | None = None) -> DataFrame:
    """(COLUMN_NAME, FEED_ROWS, MISSING, REJECTED): absent elements, and elements whose text does
    not parse as the column's type. One pass over the feed."""
    _, _, fields = feed
    entries = []
    for column, leaf, kind in fields:
        text = F.col(leaf)
        parsed = text if kind == "string" else F.trim(text).try_cast(kind)
        entries.append(
            F.struct(
                F.lit(column).alias("COLUMN_NAME"),
                F.count("*").alias("FEED_ROWS"),
                F.count_if(text.isNull()).alias("MISSING"),
                F.count_if(text.isNotNull() & parsed.isNull()).alias("REJECTED"),
            )
        )
    rows = _scan(spark, path, feed, pattern)
    return rows.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def _merged(known: T.StructType, found: T.StructType) -> T.StructType:
    """``known`` and what else was found, at every depth."""
    out, seen = T.StructType(), {f.name: f.dataType for f in found}
    for f in known:
        other = seen.pop(f.name, None)
        both = isinstance(f.dataType, T.StructType) and isinstance(other, T.StructType)
        out.add(f.name, _merged(f.dataType, other) if both else f.dataType)
    for name, kind in seen.items():
        out.add(name, kind)
    return out


def land_feed(spark: SparkSession, path: str, feed=POLICY_FEED, pattern: str | None = None) -> DataFrame:
    """Untyped landing: one ``SRC`` variant per element with all that is in it, whether the feed's fields list it or not:
    nested elements, repeated ones (as arrays) and attributes (under ``_`` and their name). Every leaf is the text it
    holds, so a code such as ``007`` stays what it is. What there is besides the listed fields is found by one pass over
    the feed before the one that lands it."""
    _, row, fields = feed
    location = f"{path.rstrip('/')}/{pattern}" if pattern else path
    reader = spark.read.format("xml").option("rowTag", row)
    found = reader.option("inferSchema", "false").load(location).schema
    rows = reader.schema(_merged(_leaf_schema(fields), found)).load(location)
    return rows.select(F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("SRC"))


LEAF_TYPES = ("bigint", "double", "boolean", "date")  # the first that all texts of a path parse as
# all that a cast takes for such a type is like this; casts of other text end in an exception each, which costs far more
LIKE = {
    "bigint": "^[^0-9A-Za-z]*[0-9][0-9.]*[^0-9A-Za-z]*$",
    "boolean": "(?i)^[^0-9A-Za-z]*(t|true|y|yes|1|f|false|n|no|0)[^0-9A-Za-z]*$",
}


def _parsed(text: Column, kind: str) -> Column:
    """``text`` as a leaf type, NULL where it does not parse."""
    return (F.when(text.rlike(LIKE[kind]), text) if kind in LIKE else text).try_cast(kind)


def feed_paths(landed: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """(PATH, ROWS, LEAVES, TYPE): where text stands in landed variants, in how many rows, how often, and the narrowest
    type that all of it parses as. Elements of arrays share a path, which ends in ``[]``.

    Walks the variants level by level, all rows at once; a level per depth of the feed. Text at the paths in ``without``
    is left where it is found, before it is stored, cast or shuffled; what is nested below such a path is walked.
    """
    source = landed.select(F.monotonically_increasing_id().alias("row"), F.lit("").alias("path"), F.col("SRC").alias("v"))
    tvf, leaves, level = landed.sparkSession.tvf, None, source
    while True:
        opened = level.lateralJoin(tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("key").isNull(), F.lit("[]")).otherwise(
            F.concat(F.when(F.col("path") == "", F.lit("")).otherwise(F.lit(".")), F.col("key"))
        )
        opened = opened.select("row", F.concat("path", step).alias("path"), F.col("value").alias("v"))
        kind = F.schema_of_variant("v")
        opened = opened.where(~F.is_variant_null("v")).select(
            "row", "path", "v", (kind.startswith("OBJECT") | kind.startswith("ARRAY")).alias("nested")
        )
        if without:
            opened = opened.where(F.col("nested") | ~F.col("path").isin(list(without)))
        # a variant taken out of another keeps all names of the whole, so leaves are stored as their text
        text = F.when(~F.col("nested"), F.try_variant_get("v", "$", "string"))
        opened = opened.select("row", "path", "nested", text.alias("text"), F.when(F.col("nested"), F.col("v")).alias("v"))
        opened = materialise(opened, "feed_level")
        found = opened.where(~F.col("nested")).select("row", "path", "text")
        leaves = found if leaves is None else leaves.unionByName(found)
        level = opened.where("nested").select("row", "path", "v")
        if level.isEmpty():
            break
    # a row's leaves of one path first, so that rows are counted without a set of them
    per_row = leaves.groupBy("path", "row").agg(
        F.count("text").alias("n"), *[F.count(_parsed(F.trim("text"), t)).alias(t) for t in LEAF_TYPES]
    )
    kind = F.coalesce(*[F.when(F.sum("n") == F.sum(t), F.lit(t)) for t in LEAF_TYPES], F.lit("string"))
    return per_row.groupBy(F.col("path").alias("PATH")).agg(
        F.count("*").alias("ROWS"), F.sum("n").alias("LEAVES"), kind.alias("TYPE")
    )


def feed_unknown_paths(landed: DataFrame, feed=POLICY_FEED) -> DataFrame:
    """``feed_paths`` of what the feed's fields do not list: what a sender has added since they were agreed."""
    _, _, fields = feed
    return feed_paths(landed, without=[path for _, path, _ in fields])


def extract_fields(landed: DataFrame, feed=POLICY_FEED) -> DataFrame:
    """Typed columns out of landed variants, the same as the typed read of the feed gives; text that does not
    parse as the column's type gives NULL."""
    _, _, fields = feed

    def typed(path: str, kind: str) -> Column:
        text = F.try_variant_get("SRC", f"$.{path}", "string")
        return text if kind == "string" else F.trim(text).try_cast(kind)

    return landed.select(*[typed(path, kind).alias(column) for column, path, kind in fields])


def load_feeds(spark: SparkSession, inbound: str, policies_to: str, claims_to: str) -> dict[str, dict[str, int]]:
    """Read both feeds of one inbound directory into Parquet tables, replacing them. The inbound
    files stay where they are. Returns per feed the row count and the rows without a key, observed
    while writing, so the XML is parsed once."""
    seen = {}
    for name, table, target in (
        ("policies", read_policy_feed(spark, inbound, POLICY_PATTERN), policies_to),
        ("claims", read_claim_feed(spark, inbound, CLAIM_PATTERN), claims_to),
    ):
        watch = Observation(name)
        observed = table.observe(
            watch, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("POLICY_ID").isNull()).alias("without_key")
        )
        observed.write.mode("overwrite").parquet(target)
        seen[name] = watch.get
    return seen
