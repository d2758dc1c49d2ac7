"""PII, secrets, licenses: against plain patterns over whole texts."""

import hashlib
import random
import string
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratewright.llm import licenses, pii, secrets


def luhn(digits):
    odd = [int(d) for d in digits[-1::-2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def plain_pii(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def spans(pattern, ok=lambda m: True):
        return [m.span() for m in re.finditer(pattern, text) if ok(m)]

    return {
        "email": spans(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": spans(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        "card": spans(r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))),
        "phone": spans(r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m.group())) <= 15),
    }


def plain_secrets(text):
    flags = re.IGNORECASE | re.ASCII
    found = [
        ("assign", *m.span())
        for m in re.finditer(
            r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, flags
        )
        if len(m.group(2)) >= 6
    ]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


PIECES = [
    "@", ".", "..", "+", "-", " ", "a", "Z", "_%", "com", "é", "\n", " ", "1", "22", "256", "255.", "10.0.0.1", "(", ")",
    "4111 1111 1111 1111", "4111111111111111", "378282246310005", "+49 30 1234567", "x@y.zz", "password", "PassWD", "api_key",
    "apiKey", "=", ": ", "\"", "'", "AKIA", "ABCDEFGHIJKLMNOP", "deadbeef", "0123456789abcdef0123456789", "secret", "token",
    "abc/def+", "ſecret", "toKen", "IBAN ", "account no. ", "DE89 3704 0044 0532 0130 00", "12345678", "http://", "https://a.b/c?d",
    "221 Baker Street", "Street", "7 Main Road,",
]
mixture = st.lists(st.sampled_from(PIECES), max_size=30).map("".join)


@settings(max_examples=400, deadline=None)
@given(mixture)
def test_base_spans_are_those_of_the_patterns(text):
    found = pii.find(text)
    assert {k: found[k] for k in pii.BASE} == plain_pii(text)
    for kind in pii.ADDED:
        assert all(a < b for a, b in found[kind])
        assert all(x[1] <= y[0] for x, y in zip(found[kind], found[kind][1:]))


@settings(max_examples=400, deadline=None)
@given(mixture)
def test_base_secrets_are_those_of_the_patterns(text):
    assert [s for s in secrets.find(text, secrets.vocabulary()) if s[0] in secrets.BASE] == plain_secrets(text)


def test_added_kinds():
    text = "see https://ex.org/a?b=1, at 221 Baker Street. IBAN: DE89 3704 0044 0532 0130 00 AND account no. 123456789"
    found = pii.find(text)
    cut = {k: [text[a:b] for a, b in found[k]] for k in pii.ADDED}
    assert cut["url"] == ["https://ex.org/a?b=1"]
    assert cut["address"] == ["221 Baker Street"]
    assert cut["account"] == ["DE89 3704 0044 0532 0130 00", "123456789"]
    assert pii.find("IBAN: DE88 3704 0044 0532 0130 00")["account"] == []
    assert pii.find("221 Baker Streets")["address"] == []


@pytest.mark.parametrize("letters", [string.ascii_lowercase, string.ascii_uppercase, string.ascii_letters])
@pytest.mark.parametrize("front", ["", "my_application_configuration_credentials=", "/var/lib/application/config/"])
def test_random_letters_alone(letters, front):
    rng, path = random.Random(11), secrets.vocabulary()
    found = 0
    for i in range(200):
        key = "".join(rng.choice(letters) for _ in range((20, 28, 40)[i % 3]))
        text = f"use {front}{key} now"
        at = text.index(key)
        found += ("random", at, at + len(key)) in secrets.find(text, path)
    assert found >= 180


def test_long_words_and_numbers_are_no_secrets(spark):
    path = secrets.vocabulary()
    words = (
        "Donaudampfschifffahrtsgesellschaft Rechtsschutzversicherungsgesellschaften Geschwindigkeitsbegrenzung "
        "anticonstitutionnellement electroencefalografista getUserAuthenticationTokenProvider "
        "Kraftfahrzeughaftpflichtversicherung pneumonoultramicroscopicsilicovolcanoconiosis 31415926535897932384626"
    )
    assert secrets.find(words, path) == []
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    spans = [t[a:b] for t in texts for k, a, b in secrets.find(t, path) if k == "random"]
    assert not any(s.isalpha() for s in spans)


def test_random_strings_and_known_identifiers():
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    path = secrets.vocabulary()
    drawn = ["".join(rng.choices(letters, k=32)) for _ in range(200)]
    assert sum(secrets.random_looking(s, path) for s in drawn) >= 190
    known = ["550e8400-e29b-41d4-a716-446655440000", "D41D8CD98F00B204E9800998ECF8427E", "internationalization_of_words_2024"]
    assert not any(secrets.random_looking(s, path) for s in known)
    assert not secrets.random_looking("internationalisierungsbeauftragte", path)
    spans = secrets.find(f"key {drawn[0]} and token={drawn[1]}", path)
    assert [s[0] for s in spans] == ["random", "assign"]


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
WORDS_IN_FRONT = [
    "my_application_configuration_credentials=", "/var/lib/application/config/credentials/", "download/report/archive/user/",
    "my_application_configuration_credentials_", "5d41402abc4b2a76b9719d911017c592/",
]


@pytest.mark.parametrize("front", WORDS_IN_FRONT)
@pytest.mark.parametrize("size", [20, 32])
def test_words_around_do_not_hide_a_secret(front, size):
    rng, path = random.Random(size), secrets.vocabulary()
    drawn = ["".join(rng.choices(LETTERS, k=size)) for _ in range(300)]
    alone = sum(bool(secrets.find(s, path)) for s in drawn)
    texts = [f"see {front}{s}/ordinary/words/behind it" for s in drawn]
    left = sum(s in secrets.redacted(t, secrets.find(t, path), "#") for s, t in zip(drawn, texts))
    assert 300 - left >= 0.97 * alone


def test_ordinary_runs_have_no_secret():
    path = secrets.vocabulary()
    for run in (
        "internationalization_of_words_2024", "/usr/local/lib/python3/dist-packages/numpy/core/tests", "blog/archive/entries/announcement/2019/07/03/v1-2-3_final",
        "/wp-content/uploads/2019/07/img-01-02", "report/550e8400-e29b-41d4-a716-446655440000/download/file_1",
        "checksum/sha256=D41D8CD98F00B204E9800998ECF8427ED41D8CD98F00B204E9800998ECF8427E",
    ):
        assert secrets.find(run, path) == [], run


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000 + "@", "1" * 100_000 + ".2", "1." * 60_000, "+1" + " " * 100_000, "a@" * 50_000):
        pii.find(text)
        secrets.find(text, secrets.vocabulary())


def test_redaction():
    text = "a password=hunter22 b deadbeefdeadbeefdeadbeefdeadbeef"
    spans = secrets.find(text, secrets.vocabulary())
    assert secrets.redacted(text, spans, "#") == "a # b #"
    assert secrets.redacted("abcdef", [("x", 0, 4), ("y", 2, 3), ("z", 3, 6)], "#") == "#"


@pytest.mark.parametrize("scan, plain, base", [(pii.scan, plain_pii, pii.BASE), (secrets.scan, plain_secrets, secrets.BASE)])
def test_tables(documents, texts, odd, odd_rows, make, scan, plain, base):
    def expected(text):
        found = plain(text)
        flat = found if isinstance(found, list) else [(k, a, b) for k in base for a, b in found[k]]
        counts = tuple(sum(s[0] == k for s in flat) for k in base)
        return (*counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in flat).encode()).hexdigest())

    for df, wanted in ((documents, sorted(texts.items())), (odd, [(r[0], r[1] or "") for r in odd_rows])):
        rows = [tuple(r)[:-1] for r in scan(df).collect()]
        assert sorted(map(repr, rows)) == sorted(repr((i, *expected(t))) for i, t in wanted)
    assert scan(make([])).collect() == []
    larger = documents.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert sum(r[1] + r[2] + r[3] for r in scan(larger).collect()) > 0


def test_license_alignment():
    text = "Intro words. This work is licensed under the GNU General Public License, version 3.\nMore of the text under version."
    ((name, coverage, a, b),) = licenses.find(text)
    assert (name, coverage, text[a:b]) == ("gpl-3.0", 1.0, "This work is licensed under the GNU General Public License, version 3")
    assert licenses.find("the MIT students released nothing under a License") == []
    near = "this work is LICENSED under GNU's general public license v. 3"
    assert [f[0] for f in licenses.find(near, coverage=0.7)] == ["gpl-3.0"]
    twice = "Released under the MIT License. " * 3 + "under the sun, MIT"
    assert [f[:2] for f in licenses.find(twice)] == [("mit", 1.0)]
    scattered = " filler filler filler filler filler filler filler filler ".join("released under the mit license".split())
    assert licenses.find(scattered) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=14), st.lists(st.sampled_from("abcdefg"), max_size=20))
def test_alignments_rise_and_match(template, text):
    found = licenses.align(template, text)
    assert all(template[i] == text[j] for i, j in found)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
    assert all((i, i) in found for i in range(len(template))) if template == text else True


def test_every_copy_of_a_notice(make):
    notice, near = "Released under the MIT License", "Released by us under the MIT License"
    text = f"{notice}. {near}. one two {notice}, and " + "some words between them " * 60 + near
    wanted = sorted((m.start(), m.end()) for m in re.finditer(f"{notice}|{near}", text))
    (row,) = licenses.scan(make([(1, text)])).collect()
    assert (row["n_licenses"], row["license"], row["coverage"]) == (1, "mit", 1.0)
    assert row["spans"] == ",".join(f"mit:{a}:{b}" for a, b in wanted)


def test_license_table(documents, texts, odd, make):
    names = {
        "apache-2.0": "Licensed under the Apache License, Version 2.0", "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
        "gpl-3.0": "This work is licensed under the GNU General Public License, version 3", "mit": "Released under the MIT License",
    }
    found = {r["doc_id"]: r for r in licenses.scan(documents).collect()}
    for i, text in texts.items():
        held = {n for n, line in names.items() if line in text}
        assert held <= {s.split(":")[0] for s in found[i]["spans"].split(",")}, i
    assert sum(r["n_licenses"] > 0 for r in found.values()) < 0.1 * len(found)
    assert {r["coverage"] for r in licenses.scan(odd).collect()} == {0.0}
    assert licenses.scan(make([])).collect() == []


@pytest.mark.parametrize(
    "text, name",
    [
        ("Released under the BSD License.", "bsd"),
        ("Released under the MIT License.", "mit"),
        ("Licensed under CC BY 4.0.", "cc-by-4.0"),
        ("Licensed under CC BY-SA 4.0.", "cc-by-sa-4.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"),
        ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc-sa-4.0"),
        ("Licensed under CC BY-ND 4.0.", None),
        ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0"),
        ("This work is licensed under the GNU General Public License, version 3 or later.", "gpl-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "lgpl-3.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "agpl-3.0"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by-4.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", None),
        ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", None),
        ("Licensed under the Apache License, Version 1.1.", None),
    ],
)
def test_words_that_tell_licenses_apart(text, name):
    for around in ("{}", "Some words before. {} And some words after it."):
        found = licenses.find(around.format(text))
        assert {licenses.license_of(f[0]) for f in found} == ({name} if name else set())


def test_a_refused_stretch_hides_no_other():
    text = "Licensed under CC BY-ND 4.0. " + "word " * 40 + "Licensed under CC BY 4.0."
    assert [f[0] for f in licenses.find(text)] == ["cc-by-4.0"]
    near = "This work is licensed under the GNU General Public License, version 2. " * 2
    both = near + "This work is licensed under the GNU General Public License, version 3."
    assert {licenses.license_of(f[0]) for f in licenses.find(both)} == {"gpl-2.0", "gpl-3.0"}


def test_a_header_and_its_short_notice_are_one_license(make):
    text = licenses.TEMPLATES["apache-2.0-header"] + " http://www.apache.org/licenses/LICENSE-2.0"
    row = licenses.scan(make([(1, text)])).first()
    assert (row["n_licenses"], row["license"]) == (1, "apache-2.0")
    assert "apache-2.0:" in row["spans"] and "apache-2.0-header:" in row["spans"]
