"""Small helpers shared by the operators: words, text columns as bytes, row batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SLAB = 64  # rows decoded at a time, so a batch of long texts is never held twice as Python objects


def words(text: bytes) -> list[bytes]:
    """Words of UTF-8 ``text`` with A-Z in lower case. ``bytes`` methods know only ASCII letters and
    split on exactly the white space that ends a word (space and 0x09 to 0x0D)."""
    return text.lower().split()


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """64-bit hashes of all words of a buffer at once; bytes in ``gaps`` part words, and one of them is a space.

    Every byte value has a random number, a word's sum of them times powers of an odd number r is its polynomial, taken
    from prefix sums over the buffer and moved to the word's start by the inverse power. Buffers are taken in
    segments, so working memory does not grow with the text.
    """

    SEGMENT = 1 << 20

    def __init__(self, gaps: bytes = b" \t\n\x0b\x0c\r", seed: int = 0):
        draw = np.random.default_rng(seed)
        self.values = draw.integers(1, 1 << 64, 256, dtype="uint64", endpoint=False)
        self.gap = np.zeros(256, bool)
        self.gap[list(gaps)] = True
        self.values[self.gap] = 0
        self.seed, self.edges = seed, bytes(gaps)
        r = (int(draw.integers(1 << 61)) << 3 | 5) % (1 << 64)  # r^k - 1 then holds few factors of 2
        self.r, self.back = r, pow(r, -1, 1 << 64)
        self.powers = self.inverse = np.ones(1, "uint64")

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("powers", self.r), ("inverse", self.back)):
                table = np.full(n, base, "uint64")
                table[0] = 1
                setattr(self, name, np.cumprod(table))

    def _segment(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(buffer, "uint8")
        if not len(raw):
            return np.empty(0, "uint64"), np.empty(0, "int64"), np.empty(0, "int64")
        self._grow(len(raw))
        edge = np.diff(self.gap[raw].view("int8"), prepend=np.int8(1), append=np.int8(1))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.cumsum(self.values[raw] * self.powers[: len(raw)])
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        return mixed((sums[ends - 1] - before) * self.inverse[starts]), starts, ends

    def _cut(self, buffer: bytes, at: int, end: int) -> int:
        """One past the last gap in ``buffer[at:end]``; 0 if it has none."""
        return max(buffer.rfind(bytes([g]), at, end) for g in self.edges) + 1

    def __call__(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of every word."""
        found, at = [], 0
        while len(buffer) - at > self.SEGMENT:
            cut = self._cut(buffer, at, at + self.SEGMENT + 1)
            if cut > at:
                h, starts, ends = self._segment(buffer[at:cut])
                found.append((h, starts + at, ends + at))
            else:  # a word longer than the segment
                after = [x for x in (buffer.find(bytes([g]), at) for g in self.edges) if x >= 0]
                cut = min(after, default=len(buffer))
                h = np.array([xxhash.xxh64_intdigest(buffer[at:cut], seed=self.seed)], "uint64")
                found.append((h, np.array([at]), np.array([cut])))
            at = cut
        h, starts, ends = self._segment(buffer[at:])
        found.append((h, starts + at, ends + at))
        return found[0] if len(found) == 1 else tuple(np.concatenate(x) for x in zip(*found))


def map_rows(
    df: DataFrame, columns: list[str], schema: str, run: Callable[..., Iterator[dict[str, list]]]
) -> DataFrame:
    """Pass ``columns`` of ``df`` to ``run`` in slabs of Arrow columns; ``run`` is called once per
    task with an iterator of (column, column, ...) and yields dicts of output columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def batches(source):
        def slabs():
            for batch in source:
                for start in range(0, batch.num_rows, SLAB):
                    piece = batch.slice(start, SLAB)
                    yield tuple(piece.column(i) for i in range(piece.num_columns))

        for result in run(slabs()):
            yield pa.RecordBatch.from_arrays(
                [
                    result[f.name] if isinstance(result[f.name], pa.Array) else pa.array(result[f.name], type=f.type)
                    for f in out
                ],
                schema=out,
            )

    return df.select(*[F.col(c) for c in columns]).mapInArrow(batches, schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """A text column as UTF-8 bytes, NULL as empty."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def as_text(column: pa.Array) -> list[str]:
    """A text column, NULL as empty."""
    return column.fill_null("").to_pylist()


def whole_rows(df: DataFrame) -> DataFrame:
    """row (a number of its own) and doc (all columns as one), so that working columns meet no column of the table."""
    return df.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"))


def numbered_columns(df: DataFrame) -> DataFrame:
    """The columns under plain names, in place of any that a map over whole rows would take for a path."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def id_type(df: DataFrame, column: str = "doc_id") -> str:
    return df.schema[column].dataType.simpleString()


def check_value(column: str = "doc_id"):
    """crc32 of an id as text; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
