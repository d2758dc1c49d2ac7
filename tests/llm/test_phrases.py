import re
from collections import Counter

import numpy as np
import pytest

from ratewright.llm import collocations as C


def plain(rows, least, longest=5, top=2000):
    """The whole task word by word: rows are (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        f = {p: n for p, n in found.items() if n >= least}
        kept = []
        for p, a in f.items():
            if len(p) < 2:
                continue
            inside = any(
                len(q) > len(p) and f[q] >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in f
            )
            if inside:
                continue
            n = totals[lang]
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        for rank, (score, a, phrase, l, r, n) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


@pytest.fixture
def mine(spark, make):
    def build(rows):
        from pyspark.sql import functions as F

        docs = make([(i, text) for i, (_, text) in enumerate(rows)])
        langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, l string")
        return docs.join(langs, "doc_id").withColumns({"lang": F.col("l"), "words": F.lit(1), "n": F.lit("x"), "rank": F.lit(2)})

    return build


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_counting(mine, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(60):
        words = rng.choice(["the", "The", "of", "new", "york", "city", "a", "a", "ß", "Ä"], size=int(rng.integers(0, 60)))
        glue = rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", ";", "\x0b"], size=len(words))
        text = "".join(w + g for w, g in zip(words, glue))
        rows.append((rng.choice(["en", "de", ""]) if rng.random() < 0.8 else None, text))
    rows += [("en", "new york city new york city") for _ in range(8)] + [("en", None), (None, ""), ("und", " . , "), ("und", "a a a a a a a")]
    got = sorted(tuple(r) for r in C.collocations(mine(rows), least=5).collect())
    assert got == plain(rows, 5)
    short = sorted(tuple(r) for r in C.collocations(mine(rows), least=5, longest=3, top=4).collect())
    assert short == plain(rows, 5, 3, 4)


def test_a_full_bitmap_changes_nothing(mine):
    docs = mine([("en", "x y z x y q w e r t y x y z"), ("en", "x y z. x y z")] * 5)

    def found(bits):
        phrases, words, _ = C.frequent_phrases(docs, 4, filter_bits=bits)
        names = {r["h"]: r["word"] for r in words.collect()}
        return sorted((" ".join(names[w] for w in r["words"]), r["n"]) for r in phrases.collect())

    assert found(6) == found(26) and ("x y z", 20) in found(6)


def test_stretches():
    h = np.array([5, 6, 7, 0, 8, 9, 0], "uint64")
    alive = np.array([1, 1, 0, 0, 1, 0], bool)  # of two words
    assert C._stretches(h, alive, 2).tolist() == [5, 6, 7, 0]
    assert C._stretches(h, np.array([1, 1, 1, 0, 1, 1, 0], bool), 1).tolist() == [5, 6, 7, 0, 8, 9, 0]
    # stretches that overlap come out apart
    h = np.arange(1, 9, dtype="uint64")
    assert C._stretches(h, np.array([1, 1, 0, 1, 1, 0], bool), 3).tolist() == [1, 2, 3, 4, 0, 4, 5, 6, 7, 0]


def test_grams():
    h = np.array([5, 6, 5, 6, 5, 0, 5, 6, 0], "uint64")
    parts, counts = C.grams(h, C._windows(h, 2), 2)
    assert sorted(zip(*(p.tolist() for p in parts), counts.tolist())) == [(5, 6, 3), (6, 5, 2)]
    parts, counts = C.grams(h, C._windows(h, 3), 3)
    assert sorted(zip(*(p.tolist() for p in parts), counts.tolist())) == [(5, 6, 5, 2), (6, 5, 6, 1)]
    assert len(C.grams(h, C._windows(h, 6), 6)[1]) == 0


def test_buckets_add_up_over_many_tasks(mine, monkeypatch):
    monkeypatch.setattr(C, "FAN_IN", 4)
    docs = mine([("en", f"w{i} x y z") for i in range(60)] + [("de", "x y")] * 9).repartition(20)
    phrases, words, _ = C.frequent_phrases(docs, 50)
    names = {r["h"]: r["word"] for r in words.collect()}
    found = sorted((r["lang"], " ".join(names[w] for w in r["words"]), r["n"]) for r in phrases.collect())
    assert found == [("en", p, 60) for p in ("x", "x y", "x y z", "y", "y z", "z")]


def test_runs():
    words = C.Words(0)
    buffer = C.plain_bytes([b"A b,, c\t d. ", b"", b".e", b"!", b"a"])
    h = words.runs(buffer).tolist()
    a, e = h[0], h[6]
    assert [x == 0 for x in h] == [False, False, True, False, False, True, False, True, False, True]
    assert h[8] == a != e and len(words.runs(C.plain_bytes([b"", b" . "]))) == 0


def test_shared_hashes_ask_for_another_seed(spark, monkeypatch):
    counted = {
        0: [("en", 7, "x", "y", 5), ("en", 8, "z", "z", 1)],
        1: [("en", 7, "x", "x", 3), ("en", 9, "y", "y", 2), ("en", 8, "z", "z", 1)],
    }
    schema = "lang string, h long, word string, other string, n long"
    monkeypatch.setattr(C, "word_counts", lambda docs, seed: spark.createDataFrame(counted[seed], schema))
    found, seed = C.vocabulary(None)
    assert seed == 1 and found.count() == 3 and found.columns == ["lang", "h", "word", "n"]


def test_empty(make):
    assert C.collocations(make([])).collect() == []
    assert C.collocations(make([(1, None), (2, "")])).collect() == []
