"""Vector best-fit packing of documents into sequences.

A piece of n tokens asks for n tokens, one document and n^2 of attention; a sequence has a capacity of each. Pieces
come by falling length, and each goes to the open sequence that it fits under every constraint and that its rule likes
best: the least weighted norm of what is left (``norm``), or the largest weighted dot product of what is asked and what
is left (``dot``). A new sequence is opened only where no open one fits.

Pieces of one length are alike, and so are sequences with the same left in all three. Best-fit is therefore worked out on
counts: how many pieces there are of each length (never more rows than a sequence has tokens, whatever the corpus),
and how many sequences stand in each state. That gives moves: the pieces of a length ranked from ``first`` on
go, ``each`` at a time, to the sequences from ``bin`` on, at ``offset``. Spark ranks the pieces of each length, in blocks, so
that no length is one task's, and looks the move up.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.text import as_text, id_type, map_rows
from ratewright.storage import materialise

TOKENS = 2048
END = 0
BLOCK_BITS = 17  # pieces of a length are ranked in blocks of 2^17 stored rows
# characters on which the fast encoder splits texts exactly as the named library does; other texts go to that library
PLAIN = re.compile(r"[\t\n\r -~¡-ÿŒœ–—‘-„…€]*")


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. Without a limit of their own, documents and attention are bounded by the tokens alone."""

    tokens: int = TOKENS
    documents: int | None = None
    attention: int | None = None

    @property
    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], "int64")

    @property
    def longest(self) -> int:
        """The longest piece that fits an empty sequence."""
        return min(self.tokens, math.isqrt(int(self.limits[2])))


def asked(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], "int64")


# -- pieces --------------------------------------------------------------------------------------


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(2)
def _encoders(path: str):
    """The named library's tokenizer, and a faster encoder over the same vocabulary."""
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    # byte-level pieces are written with one printable character for each byte: those bytes that print as they are
    # stand for themselves, the others for the code points from 256 on
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    if set(byte_of) != set(ByteLevel.alphabet()):
        raise ValueError(f"{path} is not a byte-level vocabulary")
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    ranks = {
        bytes(byte_of[c] for c in piece): i for piece, i in described["model"]["vocab"].items() if piece not in special
    }
    fast = tiktoken.Encoding(
        "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )
    return Tokenizer.from_file(path), fast


def encode(text: str, path: str) -> np.ndarray:
    """Token ids as the named library gives them."""
    library, fast = _encoders(path)
    if PLAIN.fullmatch(text):
        return fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")


def cuts(length: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: whole if short enough, else pieces of ``longest`` after a first one that may be
    shorter."""
    first = length if length <= longest else length % longest or longest
    return [(0, first), *((at, longest) for at in range(first, length, longest))]


def pieces(
    docs: DataFrame, path: str | None = None, capacity: Capacity = Capacity(), end: int = END, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece (from 0), start, length, ids_crc32 and, if asked for, ids (array<int>), a row per piece.

    NULL and empty texts are one piece of the end mark alone. Every row of ``docs`` is a document of its own, also where ids
    repeat or are NULL.
    """
    path, longest = path or vocabulary(), capacity.longest
    schema = f"doc_id {id_type(docs)}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def run(slabs):
        for doc_ids, texts in slabs:
            at, spans, sums, kept = [], [], [], []
            for i, text in enumerate(as_text(texts)):
                ids = np.append(encode(text, path), np.uint32(end)).astype("<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), longest)):
                    part = ids[start : start + length]
                    at.append(i)
                    spans.append((piece, start, length))
                    sums.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype("int32"))
            numbers, starts, lengths = zip(*spans) if spans else ((), (), ())
            out = {
                "doc_id": doc_ids.take(pa.array(at, pa.int64())),
                "piece": numbers, "start": starts, "length": lengths, "ids_crc32": sums,
            }
            yield out | ({"ids": kept} if with_ids else {})

    return map_rows(docs, ["doc_id", "text"], schema, run)


# -- best-fit on counts --------------------------------------------------------------------------


@dataclass
class Plan:
    """``sequences`` and the moves (length, first, each, bin, offset): the pieces of ``length`` of rank ``first`` to the next
    move's go, ``each`` to a sequence, to ``bin`` and those after it, the first of them at ``offset``."""

    sequences: int = 0
    moves: list[tuple[int, int, int, int, int]] = field(default_factory=list)


class _Open:
    """Open sequences by state: what is left (tokens, documents, attention), the first sequence and how many."""

    def __init__(self):
        self.left, self.first, self.count = np.empty((0, 3), "int64"), np.empty(0, "int64"), np.empty(0, "int64")

    def add(self, left: np.ndarray, first: int, count: int) -> None:
        if count and left[0] > 0 and left[1] > 0 and left[2] > 0:
            self.left = np.vstack([self.left, left])
            self.first, self.count = np.append(self.first, first), np.append(self.count, count)

    def shrink(self, at: int, taken: int) -> None:
        self.first[at] += taken
        self.count[at] -= taken

    def sweep(self, least: np.ndarray) -> None:
        """Forget what is used up or too full for the least that may still come."""
        keep = (self.count > 0) & (self.left >= least).all(1)
        self.left, self.first, self.count = self.left[keep], self.first[keep], self.count[keep]


def best_fit(
    counts: dict[int, int], capacity: Capacity = Capacity(), rule: str = "norm", weights: Sequence[float] = (1, 0, 0)
) -> Plan:
    """Vector best-fit of ``counts`` pieces by length, longest first. Sequences that a rule likes equally well are taken
    in the order in which they came to their state."""
    limits, scale = capacity.limits, np.asarray(weights, "float64")
    plan, opened = Plan(), _Open()
    lengths = sorted(counts, reverse=True)
    least = asked(lengths[-1]) if lengths else None
    for length in lengths:
        want, rank, todo = asked(length), 0, counts[length]

        def put(bins: int, each: int, start: int, left: np.ndarray) -> None:
            """``each`` pieces to each of ``bins`` sequences from ``start`` on, which have ``left`` left."""
            nonlocal rank, todo
            plan.moves.append((length, rank, each, start, int(limits[0] - left[0])))
            opened.add(left - each * want, start, bins)
            rank, todo = rank + bins * each, todo - bins * each

        opened.sweep(least)
        while todo:
            fits = np.flatnonzero((opened.count > 0) & (opened.left >= want).all(1))
            if len(fits):
                share = opened.left[fits] / limits
                if rule == "norm":
                    score = -(scale * (share - want / limits) ** 2).sum(1)
                else:
                    score = (scale * share * (want / limits)).sum(1)
                at = int(fits[score.argmax()])
                left, start, there = opened.left[at].copy(), int(opened.first[at]), int(opened.count[at])
            else:
                at, left, start, there = -1, limits, plan.sequences, todo
            # the norm falls with every piece put, so a chosen sequence is filled; the dot product falls too, so
            # its equals come first, save where only the new sequence fits
            each = int((left // want).min()) if rule == "norm" or at < 0 else 1
            full = min(there, todo // each)
            rest = todo - full * each if full < there else 0
            if at >= 0:
                opened.shrink(at, full + (rest > 0))
            else:
                plan.sequences += full + (rest > 0)
            if full:
                put(full, each, start, left)
            if rest:
                put(1, rest, start + full, left)
    return plan


def rules(counts: dict[int, int], capacity: Capacity = Capacity()) -> list[tuple[str, tuple[float, float, float]]]:
    """Rules worth trying: tokens alone, and all three by their scarcity (what all pieces ask by what a sequence has)."""
    total = sum((asked(length) * n / capacity.limits for length, n in counts.items()), np.zeros(3))
    scarce = tuple(float(x) for x in total / max(total.sum(), 1e-300))
    return [("norm", (1.0, 0.0, 0.0)), ("norm", scarce), ("dot", scarce)]


def fewest(counts: dict[int, int], capacity: Capacity = Capacity()) -> Plan:
    """The plan with the fewest sequences of ``rules``."""
    return min((best_fit(counts, capacity, *r) for r in rules(counts, capacity)), key=lambda p: p.sequences)


# -- packing -------------------------------------------------------------------------------------


def pack(
    items: DataFrame, capacity: Capacity = Capacity(), rule: str | None = None, weights: Sequence[float] = (1, 0, 0)
) -> DataFrame:
    """``items`` (a stored table with a column ``length``, from 1 to ``capacity.longest``) with sequence_id (long, from 0)
    and offset (long): the place in the sequence, gapless from 0. ``rule`` None tries several and takes the fewest
    sequences. An empty table stays empty. Columns of these two names are replaced."""
    spark = items.sparkSession
    kept = [F.col(f"item.`{c}`") for c in items.columns if c not in ("sequence_id", "offset")]
    place = F.monotonically_increasing_id()
    held = items.select(
        F.struct(*[F.col(f"`{c}`") for c in items.columns]).alias("item"), F.col("length").cast("long").alias("len"),
        place.alias("place"), F.shiftright(place, BLOCK_BITS).alias("block"),
    )
    blocks = materialise(held.groupBy("len", "block").agg(F.count("*").alias("n")), "pack_blocks")
    by_length = blocks.groupBy("len").agg(F.sum("n").alias("n")).collect()  # as many rows as a sequence has tokens
    counts = {r["len"]: r["n"] for r in by_length}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity.longest:
        raise ValueError(f"lengths must lie between 1 and {capacity.longest}")
    plan = best_fit(counts, capacity, rule, weights) if rule else fewest(counts, capacity)

    moves: dict[int, list] = {}
    for length, *move in plan.moves:
        moves.setdefault(length, []).append(tuple(move))
    schema = "len long, moves array<struct<first: long, each: long, bin: long, offset: long>>"
    by_moves = spark.createDataFrame(list(moves.items()), schema)
    before = Window.partitionBy("len").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("len", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    offsets = offsets.join(F.broadcast(by_moves), "len")  # at most as many rows as a sequence has tokens
    inside = Window.partitionBy("len", "block").orderBy("place")
    ranked = held.withColumn("nth", F.row_number().over(inside) - 1).join(offsets, ["len", "block"])
    rank = F.col("ahead") + F.col("nth")
    ranked = ranked.select("item", "len", rank.alias("rank"), F.col("moves"))
    move = F.element_at(F.filter("moves", lambda m: m["first"] <= F.col("rank")), -1)
    placed = ranked.select("item", "len", "rank", move.alias("m"))
    nth = F.col("rank") - F.col("m.first")
    sequence = F.col("m.bin") + F.floor(nth / F.col("m.each"))
    return placed.select(
        *kept,
        sequence.cast("long").alias("sequence_id"),
        (F.col("m.offset") + nth % F.col("m.each") * F.col("len")).cast("long").alias("offset"),
    )


def packed(docs: DataFrame, path: str | None = None, capacity: Capacity = Capacity(), with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset, a row per piece of every document."""
    return pack(materialise(pieces(docs, path, capacity, with_ids=with_ids), "pieces"), capacity)


def sequences(rows: DataFrame) -> DataFrame:
    """sequence_id and ids: the sequences written out, from ``packed(..., with_ids=True)``. A group holds one sequence's
    tokens at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.flatten(F.transform(parts, lambda p: p["ids"]))
    return rows.groupBy("sequence_id").agg(joined.alias("ids"))
