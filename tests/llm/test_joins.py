"""Jaccard join, top-k, fingerprints, mixing."""

import hashlib
import random

import pytest

from ratewright.llm import components, fingerprints, jaccard, mixing, topk
from ratewright.llm.workload import ORACLE, QUERIES
from workload.check import table


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def plain_join(rows):
    """[(doc_id, n, component)] by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= 75 * (len(a) + len(b) - common):
                    parent[top(i)] = top(j)
    best = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            best[top(i)] = min(best.get(top(i), doc), doc)
    return sorted(map(repr, [(doc, len(s), best.get(top(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]))


def shown(df):
    return sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in df.collect())


def test_join_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    wanted = plain_join(rows)
    assert shown(jaccard.join(docs)) == wanted
    assert len({r.split(",")[2] for r in wanted}) < len(rows)


def near_copies(rng, base, count, edits):
    out = []
    for _ in range(count):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("frequent", [1, 4, 16])
def test_join_on_near_copies(make, monkeypatch, frequent):
    """Groups of near copies with chains between them, and passages that many texts share."""
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rng = random.Random(frequent)
    texts = []
    passage = [f"p{i}" for i in range(25)]
    for g in range(6):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.choice((8, 12, 30, 60)))]
        texts += near_copies(rng, base, 25, 4)
        other = list(base)
        other[:3] = ["o1", "o2", "o3"]
        texts += near_copies(rng, other, 10, 2)
    texts += [" ".join([f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 12))] + passage) for _ in range(60)]
    rows = list(enumerate(texts))
    assert shown(jaccard.join(make(rows))) == plain_join(rows)


def test_join_on_containment_chains(make):
    """Each set inside the next, at a Jaccard of just 0.75 to 0.8: a shared token may lie behind the larger one's prefix."""
    rng = random.Random(8)
    texts = []
    for g in range(60):
        sizes = [rng.choice((57, 60, 76, 80))]
        for _ in range(4):
            share = rng.choice((75, 76, 80))
            sizes.append(sizes[-1] * 100 // share)
        word = [f"c{g}x{i}" for i in range(sizes[-1] + 4)]
        texts += [" ".join(word[: n + 4]) for n in sizes]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert shown(jaccard.join(make(rows))) == plain_join(rows)


def test_join_with_a_bounded_order(make, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 1)
    monkeypatch.setattr(jaccard, "MOST_FREQUENT", 5)
    rng = random.Random(1)
    rows = list(enumerate(near_copies(rng, [f"w{i}" for i in range(40)], 60, 4)))
    assert shown(jaccard.join(make(rows))) == plain_join(rows)


def test_join_on_odd_rows(odd, odd_rows, make):
    assert shown(jaccard.join(odd)) == plain_join([(r[0], r[1]) for r in odd_rows])
    kept = jaccard.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "8", "9"]
    assert jaccard.join(make([])).collect() == []
    assert jaccard.deduplicated(make([])).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    found = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


@pytest.mark.parametrize("name", list(ORACLE))
def test_queries_against_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    assert table(df.columns, df.collect()) == table([d[0] for d in cursor.description], cursor.fetchall())


def test_top_k_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 3)
    monkeypatch.setattr(topk, "STEP", 7)
    rng = random.Random(2)
    rows = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(3)]) for i in range(150)]
    rows += [(i, [0.5, 0.5, 0.5]) for i in range(150, 250)]  # ties
    rows += [(300, None), (301, [1.0, None, 2.0]), (302, [float("nan")] * 3), (303, [float("inf"), 0.0, 0.0]), (None, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found = {}
    for r in topk.top_k(df, k=5, every=50).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    import numpy as np

    usable = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows[:250]]
    for i, v in usable:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, u)), j) for j, u in usable if j != i)[:5]
            assert sorted(found[i]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert set(found) == {0, 50, 100, 150, 200}
    few = df.where("vec_id in (0, 1, 2)")
    assert topk.top_k(few).count() == 2
    assert topk.top_k(df.limit(0)).collect() == []


def test_fingerprints_and_edits(documents, texts):
    rows = {r["doc_id"]: r for r in fingerprints.fingerprints(documents).collect()}
    order = sorted(texts)
    assert sorted(rows) == order
    by_text = {}
    for i, at in enumerate(order):
        text, following = texts[at], texts[order[(i + 1) % len(order)]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        assert rows[at]["n_chars"] == len(text)
        assert rows[at]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        by_text.setdefault(text, set()).add(rows[at]["fingerprint"])
        f, g = rows[at]["fingerprint"], rows[order[(i + 1) % len(order)]]["fingerprint"]
        pairs = [(f[k : k + 8], g[k : k + 8]) for k in range(0, len(f), 8)]
        used = [(a, b) for a, b in pairs if a != fingerprints.EMPTY or b != fingerprints.EMPTY]
        assert rows[at]["near_next"] == pytest.approx(sum(a == b for a, b in used) / len(used) if used else 1.0)
    assert all(len(f) == 1 for f in by_text.values())


def test_fingerprints_by_hand(documents, texts):
    n = len(texts)
    df = {}
    for t in texts.values():
        for w in set(t.encode().lower().split()):
            df[w] = df.get(w, 0) + 1
    low, high = max(2, fingerprints.LOW * n), max(2, fingerprints.HIGH * n)
    lexicon = {w for w, c in df.items() if low <= c <= high}
    rows = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(documents).collect()}
    for i, text in texts.items():
        cells = [None] * fingerprints.SUBSETS
        for w in sorted(set(text.encode().lower().split()) & lexicon):
            digest = hashlib.md5(w).hexdigest()
            k = int(digest[8:16], 16) % fingerprints.SUBSETS
            cells[k] = (cells[k] or 0) ^ int(digest[:8], 16)
        assert rows[i] == "".join(fingerprints.EMPTY if c is None else f"{c:08x}" for c in cells)


def test_long_texts_keep_their_likeness(make):
    """Texts of 50 to 1,600 lexicon terms, each term in two of them: three quarters of a text stay when it is edited."""
    rng = random.Random(3)
    held = [[] for _ in range(40)]
    sizes = [(50, 100, 200, 400, 1600)[i % 5] for i in range(40)]
    for i, size in enumerate(sizes):
        near = (i + 5) % 40  # of the same length
        for k in range(size // 2):
            held[i].append(f"t{i}x{k}")
            held[near].append(f"t{i}x{k}")
    for words in held:
        rng.shuffle(words)
    rows = fingerprints.fingerprints(make([(i, " ".join(words)) for i, words in enumerate(held)])).collect()
    assert len(rows) == 40
    for r in rows:
        assert r["near_edited"] > 0.25, (sizes[r["doc_id"]], r["near_edited"])
        assert r["near_next"] < 0.1


def test_fingerprints_odd_rows(odd, odd_rows, make):
    rows = fingerprints.fingerprints(odd).collect()
    assert sorted(map(repr, [(r["doc_id"], r["n_chars"]) for r in rows])) == sorted(
        repr((r[0], len(r[1] or ""))) for r in odd_rows
    )
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert fingerprints.fingerprints(make([])).collect() == []
    alone = fingerprints.fingerprints(make([(4, "abcdefgh")])).collect()[0]
    assert alone["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 5), ("d", 0)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # weights a 5, b 2, c 1, d 5, NULL 2; a, d and NULL stop at three times their size, b and c share the rest
    assert found["a"] == 30 and found["d"] == 0 and found[None] == 15
    assert found["c"] == 300 and found["b"] == pytest.approx(1115 - 30 - 15 - 300)


def test_mix_odd_rows_and_spread(odd, odd_rows, make, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 3)
    rows = mixing.mix(odd).collect()
    assert sorted(map(repr, [(r["doc_id"], r["size"]) for r in rows])) == sorted(
        repr((r[0], len((r[1] or "").encode().split()))) for r in odd_rows
    )
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(make([])).collect() == []
    assert mixing.mixed(make([])).collect() == []
    rng = random.Random(4)
    many = make([(i, "w " * rng.randint(0, 9), rng.choice("aaaabc")) for i in range(3000)])
    found = mixing.mix(many).collect()
    taken, goal = {}, {}
    for r in found:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        goal[r["source"]] = r["target"]
    assert all(abs(taken[s] - goal[s]) <= 20 for s in goal)
    assert sum(taken.values()) <= sum(r["size"] for r in found)
    stream = mixing.mixed(make([(r["doc_id"], r["text"], r["source"]) for r in many.collect()], 7))
    assert stream.columns == many.columns
    counts = {}
    for r in stream.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + len(r["text"].split())
    assert counts == {r["doc_id"]: r["taken"] for r in found if r["taken"]}


def test_words_are_hashed_alike_in_every_segment():
    from ratewright.llm.text import WordHasher, words

    hasher = WordHasher()
    hasher.SEGMENT = 16
    parts = [b"a bb", b"", b"ccc" * 5, b"x" * 16, b"y" * 17, b"z" * 40, b"\t\n tail\x0b\x0c\r end"]
    rng = random.Random(4)
    seen = {}
    for _ in range(200):
        text = b" ".join(rng.choices(parts, k=rng.randint(0, 12)))
        h, starts, ends = hasher(text)
        assert [text[a:b] for a, b in zip(starts, ends)] == words(text)
        for word, value in zip(words(text), h.tolist()):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
