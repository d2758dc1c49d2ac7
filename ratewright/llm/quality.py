"""Quality by a factorisation machine.

A document is a sparse vector: hashed words (weighted by the logarithm of their count, unit length) and one-hot
bins of structure statistics and of the declared length. Besides a weight, each input has a short vector;
the inner products of those vectors are the weights of all pairs. Their sum is taken in linear time
as half of (square of the sum less the sum of squares). The machine is fitted on a bounded sample of labelled
rows and applied to every text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.text import as_bytes, check_value, id_type, map_rows, numbered_columns, words

HASHED = 1 << 15
BINS = 12
SAMPLE = 10_000  # labelled rows a fit uses at most
RANK = 8
THRESHOLD = 0.3
SYMBOLS = re.compile(rb"[^0-9A-Za-z\s\x80-\xff.,'-]")
UPPER = re.compile(rb"[A-Z]")
DIGIT = re.compile(rb"[0-9]")
CACHE = 300_000


def statistics(text: bytes, tokens: list[bytes], n_chars: int | None) -> list[float]:
    """Shares and logarithms between 0 and 1 that describe the shape of a text."""
    size, count = max(1, len(text)), max(1, len(tokens))
    lines = text.split(b"\n")
    return [
        min(1.0, np.log1p(len(tokens)) / 12),
        min(1.0, size / count / 24),
        len(set(tokens)) / count,
        min(1.0, 4 * len(SYMBOLS.findall(text)) / size),
        len(UPPER.findall(text)) / size,
        min(1.0, 4 * len(DIGIT.findall(text)) / size),
        min(1.0, 20 * (text.count(b".") + text.count(b"!") + text.count(b"?")) / size),
        len(set(lines)) / len(lines),
        min(1.0, np.log1p(len(lines)) / 10),
        0.0 if n_chars is None else min(1.0, np.log1p(max(0, n_chars)) / 14),
    ]


STATISTICS = 10
INPUTS = HASHED + STATISTICS * BINS


class Featuriser:
    """Word places are remembered up to a bound; later words are hashed anew each time."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def place(self, word: bytes) -> int:
        at = zlib.crc32(word) % HASHED
        if len(self.known) < CACHE:
            self.known[word] = at
        return at

    def rows(self, texts: list[bytes], sizes: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, inputs, values) of the texts; every text has at least its statistics."""
        get, place = self.known.get, self.place
        flat: list[int] = []
        counts, bins = [], []
        for text, size in zip(texts, sizes):
            tokens = words(text)
            places = [get(w) for w in tokens]
            flat += [place(w) if p is None else p for p, w in zip(places, tokens)] if None in places else places
            counts.append(len(tokens))
            shape = statistics(text, tokens, size)
            bins.append([HASHED + k * BINS + min(BINS - 1, int(s * BINS)) for k, s in enumerate(shape)])
        doc = np.repeat(np.arange(len(texts)), counts)
        keys, times = np.unique(doc * HASHED + np.asarray(flat, "int64"), return_counts=True)
        doc, inputs = keys // HASHED, keys % HASHED
        values = np.log1p(times)
        length = np.sqrt(np.bincount(doc, values * values, len(texts)))
        values = values / length[doc]
        doc = np.concatenate([doc, np.repeat(np.arange(len(texts)), STATISTICS)])
        inputs = np.concatenate([inputs, np.asarray(bins, "int64").reshape(-1)])
        values = np.concatenate([values, np.full(len(texts) * STATISTICS, 0.5)])
        order = np.argsort(doc, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
        return offsets, inputs[order], values[order].astype("float32")


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # (inputs,)
    factors: np.ndarray  # (inputs, rank)

    def margins(self, offsets, inputs, values) -> np.ndarray:
        start = offsets[:-1]
        linear = np.add.reduceat(self.weights[inputs] * values, start)
        scaled = self.factors[inputs] * values[:, None]
        total = np.add.reduceat(scaled, start, axis=0)
        squares = np.add.reduceat(scaled * scaled, start, axis=0)
        return self.bias + linear + 0.5 * (total * total - squares).sum(1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    offsets, inputs, values, labels, rank: int = RANK, epochs: int = 8, rate: float = 0.1, decay: float = 1e-5
) -> Machine:
    """Logistic loss, small batches, steps scaled by past gradients; the same data give the same machine."""
    rng = np.random.default_rng(7)
    m = Machine(0.0, np.zeros(INPUTS, "float32"), np.zeros((INPUTS, rank), "float32"))
    if not len(labels):
        return m
    share = (labels.sum() + 1) / (len(labels) + 2)
    m.bias = float(np.log(share / (1 - share)))
    if labels.min() == labels.max():
        return m
    m.factors = rng.normal(0, 0.03, (INPUTS, rank)).astype("float32")
    seen_b, seen_w, seen_f = 1e-6, np.full(INPUTS, 1e-6, "float32"), np.full((INPUTS, rank), 1e-6, "float32")
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), 128):
            batch = order[at : at + 128]
            sizes = offsets[batch + 1] - offsets[batch]
            ends = np.cumsum(sizes)
            pick = np.arange(ends[-1]) - np.repeat(ends - sizes - offsets[batch], sizes)
            x, v = inputs[pick], values[pick]
            start = np.concatenate([[0], ends[:-1]])
            local = np.concatenate([start, ends[-1:]])
            error = (sigmoid(m.margins(local, x, v)) - labels[batch]).astype("float32") / len(batch)
            each = np.repeat(error, sizes) * v
            scaled = m.factors[x] * v[:, None]
            total = np.repeat(np.add.reduceat(scaled, start, axis=0), sizes, axis=0)
            used, where = np.unique(x, return_inverse=True)
            grad_w = np.bincount(where, each, len(used)) + decay * m.weights[used]
            push = each[:, None] * (total - scaled)
            grad_f = np.stack([np.bincount(where, push[:, f], len(used)) for f in range(rank)], 1)
            grad_f += decay * m.factors[used]
            grad_b = float(error.sum())
            seen_b += grad_b**2
            m.bias -= rate * grad_b / seen_b**0.5
            seen_w[used] += grad_w**2
            m.weights[used] -= rate * grad_w / np.sqrt(seen_w[used])
            seen_f[used] += grad_f**2
            m.factors[used] -= 0.3 * rate * grad_f / np.sqrt(seen_f[used])
    return m


def _sized(docs: DataFrame):
    return F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, n_chars and label of at most ``sample`` documents outside the held-out fifth, those whose ids
    come first by a hash. A document labelled several times has the mean label, rounded up from a half; of
    several texts under one id the first in order serves."""
    chosen = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .where(check_value() % 5 != 0)
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _sized(docs).alias("n_chars"))
    found = texts.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows
    first = found.groupBy("doc_id", "label").agg(F.min(F.struct("text", "n_chars")).alias("d"))
    return first.select("doc_id", "d.text", "d.n_chars", (F.col("label") >= 0.5).cast("int").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> Machine:
    """A machine fitted on the labelled sample. Texts become inputs on the executors; the driver gets at
    most ``sample`` sparse rows."""
    schema = "doc_id string, label int, inputs array<int>, x array<float>"

    def run(slabs):
        featuriser = Featuriser()
        for ids, texts, sizes, marks in slabs:
            offsets, inputs, values = featuriser.rows(as_bytes(texts), sizes.to_pylist())
            cuts = offsets[1:-1]
            yield {
                "doc_id": [str(i) for i in ids.to_pylist()],
                "label": marks,
                "inputs": [a.astype("int32") for a in np.split(inputs, cuts)],
                "x": np.split(values, cuts),
            }

    drawn = labelled_sample(docs, labels, sample)
    rows = map_rows(drawn, ["doc_id", "text", "n_chars", "label"], schema, run).toArrow()
    order = np.argsort(np.asarray(rows["doc_id"].to_pylist(), dtype=str), kind="stable")
    inputs = [rows["inputs"][int(i)].values.to_numpy() for i in order]
    values = [rows["x"][int(i)].values.to_numpy() for i in order]
    if not len(order):
        return train(np.zeros(1, "int64"), np.empty(0, "int64"), np.empty(0, "float32"), np.empty(0))
    marks = np.asarray(rows["label"].to_pylist())[order]
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in inputs])])
    return train(offsets, np.concatenate(inputs).astype("int64"), np.concatenate(values), marks, **options)


def _margins(machine: Machine, featuriser: Featuriser, texts, sizes) -> np.ndarray:
    offsets, inputs, values = featuriser.rows(as_bytes(texts), sizes.to_pylist())
    return sigmoid(machine.margins(offsets, inputs, values).astype("float64"))


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row of ``docs``.

    NULL texts count as empty and are scored by their statistics. Equal texts of equal declared length get
    equal scores. Without usable labels every score is 0.5 and nothing is rejected.
    """
    schema = f"doc_id {id_type(docs)}, held_out boolean, score double, predicted int"

    def run(slabs):
        featuriser = Featuriser()
        for ids, held, texts, sizes in slabs:
            found = _margins(machine, featuriser, texts, sizes) if len(ids) else np.empty(0)
            yield {"doc_id": ids, "held_out": held, "score": found, "predicted": (found >= threshold).astype("int32")}

    rows = docs.select("doc_id", (check_value() % 5 == 0).alias("held_out"), "text", _sized(docs).alias("n_chars"))
    return map_rows(rows, ["doc_id", "held_out", "text", "n_chars"], schema, run)


def accept(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the machine does not reject, all columns as they are. Without a column n_chars no length
    is declared, as in ``score``."""
    names = docs.columns

    def batches(source):
        import pyarrow as pa

        featuriser = Featuriser()
        for batch in source:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                if "n_chars" in names:
                    sizes = part.column(names.index("n_chars")).cast(pa.int64())
                else:
                    sizes = pa.nulls(part.num_rows, pa.int64())
                found = _margins(machine, featuriser, part.column(names.index("text")), sizes)
                kept = part.filter(pa.array(found >= threshold))
                yield pa.RecordBatch.from_arrays(kept.columns, names=names)

    return numbered_columns(docs).mapInArrow(batches, docs.schema)
