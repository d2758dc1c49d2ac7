"""Suffix tree and quality machine."""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from ratewright.llm import quality, suffix_tree
from ratewright.storage import discard, shared_dir


def tokens(text):
    return [*text.encode().lower().split(), b"\n"]


def check(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def plain(rows):
    learn = Counter(t for i, text in rows if check(i) % 5 != 1 for t in tokens(text))
    n, v = sum(learn.values()), len(learn)
    out = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((learn[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((i, check(i) % 5 == 1, len(own), sum(learn[t] > 0 for t in own), n, round(base, 5)))
    return sorted(map(repr, out))


def shown(df):
    return sorted(
        repr((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)))
        for r in df.collect()
    )


def test_base_scores(documents, texts, odd, odd_rows, make):
    assert shown(suffix_tree.scores(documents)) == plain(sorted(texts.items()))
    assert shown(suffix_tree.scores(odd)) == plain([(r[0], r[1] or "") for r in odd_rows])
    assert suffix_tree.scores(make([])).collect() == []


class PlainTree:
    """The tree of the module's docstring over words themselves: contexts are tuples, the nearest word last."""

    def __init__(self, texts, context=None, follow=None):
        seen = [["<", *tokens(t)] for t in texts]
        self.counts = Counter(w for row in seen for w in row[1:])
        self.total, self.states = sum(self.counts.values()), {}
        kept, depth = {()}, 0
        while kept:
            depth += 1
            follows = {}
            for row in seen:
                for i in range(depth, len(row)):
                    c = tuple(row[i - depth : i])
                    if c[1:] in kept:
                        follows.setdefault(c, Counter())[row[i]] += 1
            kept = {c for c, after in follows.items() if self.keep(c, after)}

    def keep(self, context, after):
        total = sum(after.values())
        own = {w: (n - suffix_tree.DISCOUNT) / total for w, n in after.items() if n >= suffix_tree.FOLLOW}
        if total < suffix_tree.CONTEXT or not own:
            return False
        before = {w: self.log(context[1:], w) for w in own}
        rest = 1 - sum(own.values())
        left = math.log(rest / max(1 - sum(map(math.exp, before.values())), 1e-12))
        gain = sum(p * (math.log(p) - before[w]) for w, p in own.items()) + rest * left
        if total * gain < suffix_tree.EVIDENCE * len(own):
            return False
        self.states[context] = left, {w: math.log(p) for w, p in own.items()}
        return True

    def root(self, w):
        return math.log((self.counts[w] + 0.5) / (self.total + 0.5 * (len(self.counts) + 1)))

    def log(self, context, w):
        if not context:
            return self.root(w)
        left, own = self.states[context]
        return own[w] if w in own else left + self.log(context[1:], w)

    def score(self, text):
        row, out = ["<", *tokens(text)], 0.0
        for i in range(1, len(row)):
            depth = 0
            while depth < i and tuple(row[i - depth - 1 : i]) in self.states:
                depth += 1
            out += self.log(tuple(row[i - depth : i]), row[i])
        return out / math.log(10)


REPEATED = "the cat sat on the mat and the dog sat on the rug while a bird sang of the old red barn by the sea".split()


@pytest.fixture(scope="module")
def chained():
    """Texts in which words hang on one, two and three words before them."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(400):
        text = [REPEATED[k] for k in draw.integers(0, len(REPEATED), 30)]
        for _ in range(3):
            x, y = draw.choice(["up", "down"], 2)
            text += [x, y, "so", f"{x}{y}", "and" if x == y else "or", f"{x}ward"]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("hot", [1 << 20, 1])
def test_scores_equal_a_plain_suffix_tree(chained, make, monkeypatch, hot):
    monkeypatch.setattr(suffix_tree, "SLOTS", hot)  # with one slot nearly every key comes by the join
    model = PlainTree([t for i, t in chained if check(i) % 5 != 1])
    docs = make([(i, t) for i, t in chained])
    tree = suffix_tree.grow(suffix_tree.training(docs))
    by_depth = Counter(map(len, model.states))
    assert [c for c, _ in tree.sizes] == [by_depth[d] for d in range(1, len(by_depth) + 1)]
    assert len(by_depth) >= 3
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score(docs, tree).collect()}
    assert got == {i: pytest.approx(model.score(t), abs=1e-6) for i, t in chained}
    for context in [(), *list(model.states)[:: max(1, len(model.states) // 40)]]:
        known = sum(math.exp(model.log(context, w)) for w in model.counts)
        assert known + math.exp(model.log(context, "no such word")) == pytest.approx(1, abs=1e-9)


def test_base_scores_by_the_join(documents, texts, monkeypatch):
    monkeypatch.setattr(suffix_tree, "SLOTS", 16)
    assert shown(suffix_tree.scores(documents)) == plain(sorted(texts.items()))


def test_a_larger_corpus_teaches_more(spark):
    sizes = []
    for sf in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        sizes.append(suffix_tree.grow(suffix_tree.training(docs)).sizes)
    (small, *_), (large, *_) = sizes
    assert large[0] > 4 * small[0] and large[1] > 4 * small[1] and len(sizes[1]) >= len(sizes[0])


def test_contexts_help_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in suffix_tree.scores(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.97 * sum(r["base_score"] for r in held)
    assert sum(r["score"] > r["base_score"] for r in held) > 0.85 * len(held)


def test_codes_of_frequent_words_are_a_bijection():
    draw = np.random.default_rng(2)
    for size in (2, 3):
        slots = [draw.integers(0, 1 << suffix_tree.SLOT_BITS, 20_000, dtype="uint64") for _ in range(size)]
        code = suffix_tree._coded(slots)
        assert (code < 1 << suffix_tree.SLOT_BITS * size).all()
        assert all((x == y).all() for x, y in zip(slots, suffix_tree._decoded(code, size)))


def test_counts_and_lookups_travel_as_lists(make, monkeypatch):
    """Pairs of words that are all different travel in lists, a row per part and depth, not a row each."""
    draw, rows = np.random.default_rng(3), []
    made = suffix_tree.map_rows

    def kept(df, columns, schema, run):
        out = suffix_tree.materialise(made(df, columns, schema, run), "travels")
        rows.append((schema, out.count()))
        return out

    monkeypatch.setattr(suffix_tree, "map_rows", kept)
    words = [f"w{k}" for k in range(300)]
    docs = make([(i, " ".join(words[k] for k in draw.integers(0, 300, 200))) for i in range(200)])
    assert suffix_tree.scores(docs).count() == 200
    counts = [n for schema, n in rows if "shorter" in schema]
    assert counts and max(counts) <= 3 * 8 * 3 * suffix_tree.AHEAD  # tasks, parts, kinds, depths; 40,000 tokens
    assert [n for schema, n in rows if "facts" in schema][0] <= 200 + 3 * 16


def test_disk_holds_the_tree_and_one_step(chained, make, spark):
    """What only growth has read is deleted, and shuffle files go with the step they belong to."""
    folder = f"{shared_dir(spark)}/ratewright/{spark.sparkContext.applicationId}"
    docs = make(chained)
    before = set(os.listdir(folder))
    tree = suffix_tree.grow(suffix_tree.training(docs))
    left = Counter(name.rpartition("-")[0] for name in set(os.listdir(folder)) - before)
    assert left["vocabulary"] == 1 and left["suffix_level"] >= len(tree.sizes) >= 3
    assert left["follows"] == left["suffix_entries"] == 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    with pytest.raises(ValueError, match="not an intermediate table"):
        discard(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_sums_of_texts_travel_in_blocks(chained, make, monkeypatch):
    monkeypatch.setattr(suffix_tree, "SLOTS", 1)
    docs, out = make(chained), []
    tree = suffix_tree.grow(suffix_tree.training(docs))
    for size in (suffix_tree.BLOCK, 16):
        monkeypatch.setattr(suffix_tree, "BLOCK", size)
        scores = suffix_tree.score(docs, tree)
        out.append({r["doc_id"]: (r["n_known"], round(r["score"], 6), round(r["base_score"], 6)) for r in scores.collect()})
    assert out[0] == out[1] and len(out[0]) == len(chained)


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    machine = quality.Machine(0.3, rng.normal(size=quality.INPUTS), rng.normal(size=(quality.INPUTS, 4)))
    inputs, values = np.array([3, 9, 11, 5]), np.array([0.5, 1.0, 2.0, 0.25])
    direct = 0.3 + (machine.weights[inputs] * values).sum()
    for i in range(4):
        for j in range(i):
            direct += machine.factors[inputs[i]] @ machine.factors[inputs[j]] * values[i] * values[j]
    assert machine.margins(np.array([0, 4]), inputs, values)[0] == pytest.approx(direct)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    machine = quality.fit(docs, labels)
    scored = quality.score(docs, machine).join(labels, "doc_id").where("held_out").collect()
    good = [r for r in scored if r["quality"] == 1]
    poor = [r for r in scored if r["quality"] == 0]
    assert len(poor) > 50
    assert sum(r["predicted"] == 1 for r in good) > 0.95 * len(good)
    assert sum(r["predicted"] == 0 for r in poor) > 0.85 * len(poor)


def test_labels_of_the_held_out_fifth_do_not_matter(spark, documents, sf_dir):
    from pyspark.sql import functions as F

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(documents, labels), quality.fit(documents, other.repartition(3))
    assert a.bias == b.bias and (a.weights == b.weights).all() and (a.factors == b.factors).all()


def test_quality_odd_tables(spark, odd, odd_rows, make):
    labels = spark.createDataFrame([(5, 1), (7, 0), (7, 0), (None, 1), (4, None), (99, 1)], "doc_id long, quality int")
    rows = quality.score(odd, quality.fit(odd, labels)).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    none = quality.fit(odd, labels.limit(0))
    assert {r["score"] for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.accept(odd, none).count() == len(odd_rows)
    assert quality.score(make([]), none).collect() == []
