"""Data dictionary: tables and columns with their types, profile and business descriptions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DESCRIPTIONS = "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, DESCRIPTION string, UPDATED_AT timestamp"
KEYS = ["TABLE_SCHEMA", "TABLE_NAME"]

# SQL names of the types a table can hold.
TYPE_NAMES = {
    "boolean": "BOOLEAN",
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "binary": "BLOB",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return f"{sql_type(kind.elementType)}[]"
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return TYPE_NAMES.get(kind.simpleString(), kind.simpleString().upper())


def catalog_tables(spark: SparkSession, schema: str) -> dict[tuple[str, str], DataFrame]:
    """Tables and views of one catalog schema, as (schema, name) -> frame."""
    return {
        (schema, t.name): spark.table(f"`{schema}`.`{t.name}`")
        for t in spark.catalog.listTables(schema)
        if not t.isTemporary
    }


def table_profile(tables: Mapping[tuple[str, str], DataFrame], kinds: Mapping[tuple[str, str], str] | None = None) -> DataFrame:
    """(TABLE_SCHEMA, TABLE_NAME, TABLE_TYPE, ROW_COUNT, COLUMN_COUNT): one count per table, which
    a Parquet scan answers from file footers, unioned into one job."""
    kinds = kinds or {}
    parts = [
        df.agg(F.count("*").alias("ROW_COUNT")).select(
            F.lit(schema).alias("TABLE_SCHEMA"),
            F.lit(name).alias("TABLE_NAME"),
            F.lit(kinds.get((schema, name), "BASE TABLE")).alias("TABLE_TYPE"),
            "ROW_COUNT",
            F.lit(len(df.columns)).alias("COLUMN_COUNT"),
        )
        for (schema, name), df in tables.items()
    ]
    return _union(parts)


def table_sizes(spark: SparkSession, paths: Mapping[tuple[str, str], str]) -> DataFrame:
    """(TABLE_SCHEMA, TABLE_NAME, FILES, BYTES, LAST_ALTERED) of file-based tables from the listing of their
    folders; no file is opened, and files without rows count like any other."""
    parts = []
    for (schema, name), path in paths.items():
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet"
        )
        files = listing.load(path).select("length", "modificationTime")
        parts.append(
            files.agg(
                F.count("*").alias("FILES"),
                F.coalesce(F.sum("length"), F.lit(0)).alias("BYTES"),
                F.max("modificationTime").alias("LAST_ALTERED"),
            ).select(F.lit(schema).alias("TABLE_SCHEMA"), F.lit(name).alias("TABLE_NAME"), "FILES", "BYTES", "LAST_ALTERED")
        )
    return _union(parts)


def with_sizes(profile: DataFrame, sizes: DataFrame) -> DataFrame:
    """A table profile with BYTES and LAST_ALTERED of ``table_sizes``; NULL for tables without files."""
    return profile.join(sizes.select(*KEYS, "BYTES", "LAST_ALTERED"), KEYS, "left")


def with_distincts(columns: DataFrame, profiles: DataFrame) -> DataFrame:
    """A column profile with DISTINCT_COUNT of ``sketches.profile``, whose tables go by their names alone."""
    found = profiles.select("TABLE_NAME", "COLUMN_NAME", "DISTINCT_COUNT")
    return columns.join(found, ["TABLE_NAME", "COLUMN_NAME"], "left")


def schema_rollup(profile: DataFrame) -> DataFrame:
    """(TABLE_SCHEMA, TABLES, COLUMN_COUNT, ROW_COUNT) per schema, and BYTES if the profile has them."""
    sums = [c for c in ("COLUMN_COUNT", "ROW_COUNT", "BYTES") if c in profile.columns]
    return profile.where("upper(TABLE_SCHEMA) <> 'INFORMATION_SCHEMA'").groupBy("TABLE_SCHEMA").agg(
        F.count("*").alias("TABLES"), *[F.sum(c).alias(c) for c in sums]
    )


def column_profile(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """One row per column: position, type, nullability, precision and scale, and from a single pass
    over each table the missing values and the longest text. Declared comments are carried along."""
    parts = []
    for (schema, name), df in tables.items():
        entries = []
        for position, f in enumerate(df.schema.fields, start=1):
            kind = f.dataType
            decimal = isinstance(kind, T.DecimalType)
            longest = F.max(F.length(F.col(f"`{f.name}`"))) if isinstance(kind, T.StringType) else F.lit(None)
            entries.append(
                F.struct(
                    F.lit(position).alias("ORDINAL_POSITION"),
                    F.lit(f.name).alias("COLUMN_NAME"),
                    F.lit(sql_type(kind)).alias("DATA_TYPE"),
                    F.lit("YES" if f.nullable else "NO").alias("IS_NULLABLE"),
                    F.lit(f.metadata.get("CURRENT_DEFAULT")).cast("string").alias("COLUMN_DEFAULT"),
                    longest.cast("int").alias("MAX_LENGTH"),
                    F.lit(kind.precision if decimal else None).cast("int").alias("NUMERIC_PRECISION"),
                    F.lit(kind.scale if decimal else None).cast("int").alias("NUMERIC_SCALE"),
                    F.count_if(F.col(f"`{f.name}`").isNull()).alias("NULL_COUNT"),
                    F.lit(f.metadata.get("comment")).cast("string").alias("COLUMN_COMMENT"),
                )
            )
        row = df.agg(F.array(*entries).alias("columns"))
        parts.append(
            row.select(F.lit(schema).alias("TABLE_SCHEMA"), F.lit(name).alias("TABLE_NAME"), F.inline("columns"))
        )
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("no tables to describe")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# -- descriptions ------------------------------------------------------------------------------


def no_descriptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DESCRIPTIONS)


def describe(current: DataFrame, new: DataFrame) -> DataFrame:
    """Descriptions after an update: one row per (schema, table, column), the text with the latest
    UPDATED_AT. A NULL column name describes the table itself. A text without a time is older than any
    with one; at equal times the update wins over what is there, then the text that sorts last."""
    both = current.withColumn("turn", F.lit(0)).unionByName(new.withColumn("turn", F.lit(1)))
    age = F.struct(F.col("UPDATED_AT"), F.col("turn"), F.col("DESCRIPTION"))
    # grouping takes NULLs for equal
    latest = both.groupBy(*KEYS, "COLUMN_NAME").agg(F.max(age).alias("t"))
    return latest.select(*KEYS, "COLUMN_NAME", "t.DESCRIPTION", "t.UPDATED_AT")


def mirror_descriptions(spark: SparkSession, descriptions: DataFrame) -> int:
    """Write descriptions into the catalog as table and column comments; returns how many. The
    statements are one per described object, so their number follows the catalog, not the data."""
    done = 0
    for row in descriptions.collect():
        table = f"`{row['TABLE_SCHEMA']}`.`{row['TABLE_NAME']}`"
        text = row["DESCRIPTION"].replace("\\", "\\\\").replace("'", "\\'")
        if row["COLUMN_NAME"] is None:
            spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")
        else:
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{row['COLUMN_NAME']}` COMMENT '{text}'")
        done += 1
    return done


def build_dictionary(tables: DataFrame, columns: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Tables joined with their columns and with both kinds of description; catalog comments fill
    in where no description was given. BYTES and LAST_ALTERED (``with_sizes``) and DISTINCT_COUNT (``with_distincts``) are
    carried along where they are known."""
    more = [c for c in ("BYTES", "LAST_ALTERED") if c in tables.columns]
    more += [c for c in ("DISTINCT_COUNT",) if c in columns.columns]
    about_tables = descriptions.where("COLUMN_NAME IS NULL").select(
        *KEYS, F.col("DESCRIPTION").alias("TABLE_DESCRIPTION")
    )
    about_columns = descriptions.where("COLUMN_NAME IS NOT NULL").select(
        *KEYS, "COLUMN_NAME", F.col("DESCRIPTION").alias("given")
    )
    return (
        tables.where("upper(TABLE_SCHEMA) <> 'INFORMATION_SCHEMA'")
        .join(columns, KEYS)
        .join(about_tables, KEYS, "left")
        .join(about_columns, [*KEYS, "COLUMN_NAME"], "left")
        .select(
            *KEYS,
            "TABLE_TYPE",
            "ROW_COUNT",
            "TABLE_DESCRIPTION",
            F.col("ORDINAL_POSITION").alias("COL_POSITION"),
            "COLUMN_NAME",
            "DATA_TYPE",
            "IS_NULLABLE",
            "MAX_LENGTH",
            "NUMERIC_PRECISION",
            "NUMERIC_SCALE",
            "COLUMN_DEFAULT",
            F.coalesce("given", "COLUMN_COMMENT").alias("COLUMN_DESCRIPTION"),
            *more,
        )
    )


def register_dictionary(dictionary: DataFrame, name: str = "DATA_DICTIONARY") -> str:
    """The dictionary as a view of the session, for SQL; it replaces an earlier one."""
    dictionary.createOrReplaceTempView(name)
    return name


def of_table(dictionary: DataFrame, table: str) -> DataFrame:
    return dictionary.where(F.col("TABLE_NAME") == table).orderBy("COL_POSITION")


def undocumented(dictionary: DataFrame) -> DataFrame:
    return (
        dictionary.where("COLUMN_DESCRIPTION IS NULL")
        .orderBy("TABLE_SCHEMA", "TABLE_NAME", "COL_POSITION")
        .select("TABLE_SCHEMA", "TABLE_NAME", "COLUMN_NAME", "DATA_TYPE")
    )


def coverage(dictionary: DataFrame) -> DataFrame:
    """(TABLE_SCHEMA, TABLE_NAME, COLUMNS, DESCRIBED, COVERAGE) with COVERAGE in percent."""
    return dictionary.groupBy(*KEYS).agg(
        F.count("*").alias("COLUMNS"),
        F.count("COLUMN_DESCRIPTION").alias("DESCRIBED"),
        (100 * F.count("COLUMN_DESCRIPTION") / F.count("*")).alias("COVERAGE"),
    )
