"""Claims on a name and version, and digests of stored rows.

A claim is an empty file created exclusively, so of two writers that want the same version one wins before either writes
data. A digest adds up 64 bits of a hash of each row (60 of the MD5 of its key): it depends on the rows and how often each
is there, not on their order, files or partitions, so it is computed in the pass that writes them and again from what is
stored. Values that SQL holds equal, as 0.0 and -0.0, have equal hashes.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from urllib.parse import quote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_KEY = "null"
FORM = "hash64:"  # how rows are hashed; part of a row digest
ROW_BITS, KEY_BITS = "digested_row_bits", "digested_key_bits"


def claim_path(root: str, kind: str, name: str, version: str) -> str:
    return f"{root}/claims/{kind}/{quote(name, safe='')}/{quote(version, safe='')}"


def take(spark: SparkSession, path: str) -> bool:
    """Create the claim; False if there is one. Exclusive on local disks and wherever the file system's own create
    without overwriting is."""
    parts = urlparse(path)
    if parts.scheme in ("", "file") and _file_system(spark, path)[0].getScheme() == "file":
        os.makedirs(os.path.dirname(parts.path), exist_ok=True)
        try:
            os.close(os.open(parts.path, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    system, place = _file_system(spark, path)
    try:
        system.create(place, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def release(spark: SparkSession, path: str) -> None:
    """Give a claim up: the write failed, or its writer is known to be gone."""
    system, place = _file_system(spark, path)
    system.delete(place, False)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _bits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(20,0)")


def key_text(keys: Sequence[str]) -> Column:
    """A row's key as text, part by part, as ``CAST(... AS VARCHAR)`` shows it."""
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit(NULL_KEY)) for k in keys])


def _json_text(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def _row_bits(df: DataFrame) -> Column:
    """One 64-bit hash of all columns, which takes a fraction of the time that JSON text and its MD5 take. Hashes pass over
    NULLs, so whether a column has a value is hashed as well; of nested columns, whose NULLs would be lost, their JSON text."""
    parts = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        parts += [c.isNull(), c if isinstance(field.dataType, T.AtomicType) else F.to_json(F.struct(c))]
    return F.xxhash64(*parts).cast("decimal(20,0)")


def marked(df: DataFrame, keys: Sequence[str], form: str = FORM) -> DataFrame:
    """``df`` and the bits of its rows and keys that ``digests`` adds up. Without a form, rows as JSON text, as records
    have them that were written before there were forms."""
    row = _row_bits(df) if form else _bits(_json_text(df))
    # apart from the sums: many columns inside an aggregate make methods too long to be compiled
    return df.select("*", row.alias(ROW_BITS), _bits(key_text(keys)).alias(KEY_BITS))


def form_of(digest: str | None) -> str:
    return FORM if digest is None or digest.startswith(FORM) else ""


def digests(form: str = FORM) -> list[Column]:
    """Aggregates over ``marked`` rows: rows, row_digest (all columns, in their order) and key_digest."""

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("string")

    return [
        F.count(F.lit(1)).alias("rows"),
        F.concat(F.lit(form), total(ROW_BITS)).alias("row_digest"),
        total(KEY_BITS).alias("key_digest"),
    ]
