"""Phrase collocations by set-oriented mining.

The occurrence relation of length k holds, in the order of (piece, position), where a frequent phrase of k words begins. It
is stored in runs: a run is a stretch of words in which every k in a row are frequent, and a 0 parts it from the next,
so a position's neighbour in the array is its neighbour in the piece. The step from k to k + 1 is

* the merge-join of the relation with itself on adjacent positions: the windows of k + 1 words in a run;
* group and count: every task counts its windows, and Spark adds the counts up by phrase. Longer windows, most of which
  are rare, are counted in hashed buckets first: those in a bucket below the least count cannot be frequent, and go.
  Windows of two words are about as many as there are words, and would fill all buckets of a large corpus;
* the semi-join with the frequent groups, whose result is stored as the next relation.

Buckets and semi-join are bitmaps over hashes of phrases, of bounded size. They let a few others through, the more the
larger the corpus, which makes work but never a count: every group is counted over all its occurrences, and only
then held against the least count. Words stand in the relations as 64-bit hashes, which are checked to be distinct within the
vocabulary; phrases are never hashed, but are lists of words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.text import WordHasher, as_bytes, as_text, map_rows, mixed
from ratewright.storage import materialise

LEAST = 100  # occurrences of a phrase
LONGEST = 5  # words
TOP = 2000  # phrases reported for a language
COVER = 100  # percent of its occurrences that a phrase has inside a longer one, and so goes
UNKNOWN = "und"
FILTER_BITS = 26  # at most; two less than the corpus has words do for a smaller one
BUCKETED = 3  # words from which on windows are counted in buckets first
CHUNK_BITS = 16
FAN_IN = 64  # tasks whose buckets are added up at a time
CACHE = 300_000  # words a task counts before it passes them on
BUFFER = 1 << 22  # bytes of text hashed at a time
WORDS = 1_000_000  # words counted at a time
SALTS = 256
BREAK = b"\xff"  # no byte of a text

# A-Z to a-z, tabs to spaces, and what ends a piece to the break
_TABLE = bytes(
    0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_FACTORS = [np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) % (1 << 64)) for j in range(64)]


def plain_bytes(texts: list[bytes]) -> bytes:
    """Texts in lower case, with a break after every piece."""
    return BREAK.join([*texts, b""]).translate(_TABLE)


class Words:
    """Hashes of the words of texts; 0, which no word has, stands where a piece ends."""

    def __init__(self, seed: int):
        self.hasher = WordHasher(b" " + BREAK, seed)

    def spans(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of every word of a buffer from ``plain_bytes``."""
        h, starts, ends = self.hasher(buffer)
        return np.maximum(h, np.uint64(1)), starts, ends

    def runs(self, buffer: bytes) -> np.ndarray:
        """The hashes in turn, with a 0 after the last word of each piece."""
        h, starts, _ = self.spans(buffer)
        if not len(h):
            return h
        ends = np.flatnonzero(np.frombuffer(buffer, "uint8") == 0xFF)
        after = np.unique(np.searchsorted(starts, ends))  # words before each end
        return np.insert(h, after[after > 0], np.uint64(0))


def _places(lang: str, h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the phrases of k words that begin at ``at``; the last bits are their places in a bitmap."""
    words = mixed(h)
    total = np.full(len(at), xxhash.xxh64_intdigest(lang.encode()), "uint64")
    for j in range(k):
        total += words[at + j] * _FACTORS[j]
    return mixed(total)


def _among(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    places = places & np.uint64(64 * len(bits) - 1)
    return (bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) != 0


def _lang(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"), "text")


# -- relations -----------------------------------------------------------------------------------


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """lang, h (hash), word, other, n of every word: ``other`` differs from ``word`` where two words share a hash."""

    def rows(lang: str, found: dict[bytes, list[int]]):
        return {
            "lang": pa.repeat(pa.scalar(lang), len(found)),
            "h": np.array([h for h, _ in found.values()], "uint64").view("int64"),
            "word": pa.array(list(found), pa.binary()).cast(pa.string()),
            "n": [n for _, n in found.values()],
        }

    def run(slabs):
        words, held, counts = Words(seed), {}, {}

        def count(lang: str) -> None:
            buffer = plain_bytes(held.pop(lang))
            found = counts.setdefault(lang, {})
            h, starts, ends = words.spans(buffer)
            _, first, many = np.unique(h, return_index=True, return_counts=True)
            for hashed, a, b, n in zip(h[first].tolist(), starts[first].tolist(), ends[first].tolist(), many.tolist()):
                found.setdefault(buffer[a:b], [hashed, 0])[1] += n

        for langs, texts in slabs:
            for lang, text in zip(as_text(langs), as_bytes(texts)):
                held.setdefault(lang, []).append(text)
            if sum(len(t) for ts in held.values() for t in ts) > BUFFER:
                for lang in list(held):
                    count(lang)
            if sum(map(len, counts.values())) > CACHE:
                yield from (rows(*x) for x in counts.items())
                counts = {}
        for lang in list(held):
            count(lang)
        yield from (rows(*x) for x in counts.items())

    counted = map_rows(_lang(docs), ["lang", "text"], "lang string, h long, word string, n long", run)
    return counted.groupBy("lang", "h").agg(
        F.min("word").alias("word"), F.max("word").alias("other"), F.sum("n").alias("n")
    )


def vocabulary(docs: DataFrame) -> tuple[DataFrame, int]:
    """lang, h, word, n of every word, stored, and the seed under which no two words share a hash."""
    for seed in range(16):
        found = materialise(word_counts(docs, seed), "words")
        if found.where("word <> other").isEmpty():
            return found.drop("other"), seed
    raise RuntimeError("words share hashes under every seed tried")


def _stretches(h: np.ndarray, alive: np.ndarray, k: int) -> np.ndarray:
    """Runs of the relation of length k: ``alive`` marks the positions at which frequent phrases begin. Only stretches of
    two and more are kept, for others have no neighbour to be joined with."""
    edge = np.diff(np.concatenate([[0], alive.astype("int8"), [0]]))
    first, length = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1)
    first, length = first[length > 1], length[length > 1]
    if not len(first):
        return h[:0]
    words = length + k - 1
    ends = np.cumsum(words + 1)  # with the 0 behind each
    at = np.arange(ends[-1]) - np.repeat(ends - words - 1 - first, words + 1)
    out = h[np.minimum(at, len(h) - 1)]
    out[ends - 1] = 0
    return out


def _windows(h: np.ndarray, k: int) -> np.ndarray:
    """Where k words in a row stand within one run."""
    whole = h[: len(h) - k + 1] != 0
    for j in range(1, k):
        whole &= h[j : len(h) - k + 1 + j] != 0
    return np.flatnonzero(whole)


def _semi_joined(h: np.ndarray, lang: str, bits: np.ndarray, k: int) -> np.ndarray:
    if len(h) < k:
        return h[:0]
    alive = np.zeros(len(h) - k + 1, bool)
    at = _windows(h, k)
    alive[at] = _among(bits, _places(lang, h, at, k))
    return _stretches(h, alive, k)


def first_relation(docs: DataFrame, bits: np.ndarray, seed: int) -> DataFrame:
    """lang, words: the runs of frequent words of two words and more, a few texts of a language to a row."""

    def run(slabs):
        words = Words(seed)
        for langs, texts in slabs:
            names, lists = [], []
            held: dict[str, list[bytes]] = {}
            for lang, text in zip(as_text(langs), as_bytes(texts)):
                held.setdefault(lang, []).append(text)
            for lang, mine in held.items():
                found = _semi_joined(words.runs(plain_bytes(mine)), lang, bits, 1)
                if len(found):
                    names.append(lang)
                    lists.append(found.view("int64"))
            yield {"lang": names, "words": lists}

    return map_rows(_lang(docs), ["lang", "text"], "lang string, words array<long>", run)


def next_relation(relation: DataFrame, bits: np.ndarray, k: int) -> DataFrame:
    """The relation of length k from that of length k - 1."""

    def run(slabs):
        for langs, words in slabs:
            names, lists = [], []
            for i, lang in enumerate(as_text(langs)):
                found = _semi_joined(_array(words, i), lang, bits, k)
                if len(found):
                    names.append(lang)
                    lists.append(found.view("int64"))
            yield {"lang": names, "words": lists}

    return map_rows(relation, ["lang", "words"], "lang string, words array<long>", run)


def _array(words: pa.Array, i: int) -> np.ndarray:
    return words[i].values.to_numpy().view("uint64")


def _held(slabs) -> Iterator[tuple[str, np.ndarray]]:
    """Runs of a relation by language, some WORDS words at a time."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0
    for langs, words in slabs:
        for i, lang in enumerate(as_text(langs)):
            held.setdefault(lang, []).append(_array(words, i))  # ends with a 0
            size += len(held[lang][-1])
            if size >= WORDS:
                yield from ((lang, np.concatenate(lists)) for lang, lists in held.items())
                held, size = {}, 0
    yield from ((lang, np.concatenate(lists)) for lang, lists in held.items())


def promising(relation: DataFrame, k: int, least: int, filter_bits: int) -> np.ndarray:
    """A bitmap of the buckets in which windows of k words occur ``least`` times and more, all together. Buckets count
    up to 255."""
    size = 1 << min(CHUNK_BITS, filter_bits)

    def run(slabs):
        buckets = np.zeros(1 << filter_bits, "uint8")
        for lang, h in _held(slabs):
            at = _windows(h, k) if len(h) >= k else np.empty(0, "int64")
            places = _places(lang, h, at, k) & np.uint64(len(buckets) - 1)
            places, counts = np.unique(places, return_counts=True)
            buckets[places] = np.minimum(buckets[places] + counts, 255)
        part = TaskContext.get().partitionId()
        for chunk, data in enumerate(buckets.reshape(-1, size)):
            if data.any():
                yield {"part": [part], "chunk": [chunk], "data": [zlib.compress(data.tobytes(), 1)]}

    def counts_of(data: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(data), "uint8")

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size, "uint32")
        for data in rows["data"]:
            total += counts_of(data)
        data = zlib.compress(np.minimum(total, 255).astype("uint8").tobytes(), 1)
        return pd.DataFrame({"part": [int(rows["part"].iat[0]) // FAN_IN], "chunk": [rows["chunk"].iat[0]], "data": [data]})

    def often(slabs):
        for chunks, datas in slabs:
            bits = [np.packbits(counts_of(d.as_py()) >= min(least, 255), bitorder="little").tobytes() for d in datas]
            yield {"chunk": chunks, "bits": bits}

    schema = "part int, chunk int, data binary"
    counted = map_rows(relation, ["lang", "words"], schema, run)
    many = relation.rdd.getNumPartitions()
    while many > 1:
        counted = counted.groupBy(F.floor(F.col("part") / FAN_IN), "chunk").applyInPandas(add, schema)
        many = -(-many // FAN_IN)
    out = np.zeros((1 << filter_bits) // 8, "uint8").reshape(-1, size // 8)
    for r in map_rows(counted, ["chunk", "data"], "chunk int, bits binary", often).toLocalIterator():
        out[r["chunk"]] = np.frombuffer(r["bits"], "uint8")
    return out.ravel().view("uint64")


def grams(h: np.ndarray, at: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct windows of k words that begin at ``at``, as k arrays, and their counts. Codes of a task stand for
    prefixes, so windows are told apart exactly."""
    if not len(at):
        return [h[:0]] * k, np.empty(0, "int64")
    known = np.unique(h)
    word = np.searchsorted(known, h).astype("uint64")
    code, prefixes, shift = word[at], [], np.uint64(32)
    for j in range(1, k):
        key = (code << shift) | word[at + j]
        if j < k - 1:
            prefixes.append(np.unique(key))
            code = np.searchsorted(prefixes[-1], key).astype("uint64")
    key, counts = np.unique(key, return_counts=True)
    parts = []
    for table in (*reversed(prefixes), None):
        parts.append(known[key & np.uint64((1 << 32) - 1)])
        code = key >> shift
        key = code if table is None else table[code]
    return [known[key], *reversed(parts)], counts


def phrase_counts(relation: DataFrame, k: int, least: int, filter_bits: int) -> DataFrame:
    """lang, words (array<long>), n: the windows of k words of a relation of length k - 1 that occur ``least`` times and
    more."""
    names = [f"w{j}" for j in range(k)]
    bits = promising(relation, k, least, filter_bits) if k >= BUCKETED else None

    def run(slabs):
        for lang, h in _held(slabs):
            at = _windows(h, k) if len(h) >= k else np.empty(0, "int64")
            if bits is not None:
                at = at[_among(bits, _places(lang, h, at, k))]
            parts, counts = grams(h, at, k)
            yield {
                "lang": pa.repeat(pa.scalar(lang), len(counts)),
                **{c: p.view("int64") for c, p in zip(names, parts)},
                "n": counts,
            }

    schema = f"lang string, {', '.join(f'{c} long' for c in names)}, n long"
    counted = map_rows(relation, ["lang", "words"], schema, run)
    summed = counted.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= least).select("lang", F.array(*names).alias("words"), "n")


def _bitmap(phrases: DataFrame, filter_bits: int) -> np.ndarray:
    """2^filter_bits bits over the phrases' places, whatever their number."""
    last = np.uint64((1 << filter_bits) - 1)

    def run(slabs):
        for langs, words in slabs:
            out = np.empty(len(langs), "uint64")
            names = np.array(as_text(langs), object)
            k = len(words[0]) if len(words) else 0
            flat = words.flatten().to_numpy().view("uint64")
            for lang in set(names):
                mine = np.flatnonzero(names == lang)
                out[mine] = _places(lang, flat, mine * k, k)
            out &= last
            yield {"w": (out >> np.uint64(6)).view("int64"), "b": (np.uint64(1) << (out & np.uint64(63))).view("int64")}

    placed = map_rows(phrases, ["lang", "words"], "w long, b long", run)
    found = placed.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bits = np.zeros(1 << (filter_bits - 6), "int64")
    bits[found["w"].to_numpy()] = found["b"].to_numpy()
    return bits.view("uint64")


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, filter_bits: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, words, n) of all phrases of 1 to ``longest`` words that occur ``least`` times and more in their language,
    (lang, h, word, n) of the frequent words, and (lang, n) of all word occurrences."""
    every, seed = vocabulary(docs)
    if filter_bits is None:
        many = every.agg(F.sum("n").alias("n")).first()["n"] or 0
        filter_bits = min(FILTER_BITS, max(CHUNK_BITS, int(many).bit_length() - 2))
    words = every.where(F.col("n") >= least)
    found = [words.select("lang", F.array("h").alias("words"), "n")]
    relation = first_relation(docs, _bitmap(found[0], filter_bits), seed)
    for k in range(2, longest + 1):
        relation = materialise(relation, f"relation_{k - 1}")
        often = materialise(phrase_counts(relation, k, least, filter_bits), f"frequent_{k}")
        found.append(often)
        if k < longest:
            relation = next_relation(relation, _bitmap(often, filter_bits), k)
    together = found[0]
    for more in found[1:]:
        together = together.unionAll(more)
    return together, words, every.groupBy("lang").agg(F.sum("n").alias("n"))


# -- scores --------------------------------------------------------------------------------------


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, words, a, l, r, n, score: the lowest-scoring cut of each phrase of two words and more; products are decimals
    of 38 digits."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.slice("words", F.lit(1), k).alias("head"),
            F.slice("words", k + 1, F.size("words") - k).alias("tail"),
        ),
    )
    cut = phrases.where(F.size("words") > 1).select("lang", "words", F.col("n").alias("a"), F.inline(cuts))
    heads = phrases.select("lang", F.col("words").alias("head"), F.col("n").alias("l"))
    tails = phrases.select("lang", F.col("words").alias("tail"), F.col("n").alias("r"))
    parts = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(F.broadcast(totals), "lang")
    exact = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")}
    parts = parts.withColumns({f"{c}_exact": e for c, e in exact.items()})
    score = F.expr("(1000 * a_exact * n_exact) div (l_exact * r_exact)").alias("score")
    best = parts.groupBy("lang", "words", "a", "n").agg(F.min(F.struct(score, "k", "l", "r")).alias("c"))
    return best.select("lang", "words", "a", "c.l", "c.r", "n", "c.score")


def covered(phrases: DataFrame) -> DataFrame:
    """lang, words, most: phrases inside longer ones, with the count of the most frequent of those."""
    size = F.size("words")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda at: F.slice("words", at, k)),
        )
    )
    inside = phrases.where(size > 2).select("lang", F.explode(inner).alias("words"), "n")
    return inside.groupBy("lang", "words").agg(F.max("n").alias("most"))


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER
) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score of each language's first ``top`` phrases by score and a (falling), then
    phrase (UTF-8 byte order).

    A-Z count as a-z; phrases do not cross ``.,;:!?`` or line ends. NULL texts hold nothing, a NULL language is ``und``.
    Repeated rows count each time. Ties between cuts go to the first. Texts without a frequent phrase, and empty
    tables, give no rows. Other columns are not read.
    """
    phrases, words, totals = frequent_phrases(docs, least, longest)
    phrases = materialise(phrases, "phrases")
    kept = scored(phrases, totals).join(covered(phrases), ["lang", "words"], "left")
    kept = kept.where(F.coalesce(100 * F.col("most") < cover * F.col("a"), F.lit(True))).drop("most")
    spelled = kept.select("*", F.posexplode("words").alias("at", "h")).join(words.select("lang", "h", "word"), ["lang", "h"])
    spelled = spelled.groupBy("lang", "words", "a", "l", "r", "n", "score").agg(
        F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w")
    )
    phrase = F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase")
    named = spelled.select("lang", phrase, "a", "l", "r", "n", "score")
    # the first of each salt, then of all salts
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = named.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    first = first.where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
