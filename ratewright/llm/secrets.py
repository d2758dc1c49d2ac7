"""Secrets: three plain patterns, and a token-efficiency test for random strings.

A public byte-pair vocabulary packs words into long tokens and random characters into short ones. A run
of key-like characters with few characters per token is taken for a secret, and so is any part of a longer run with
a stretch like that, whatever words stand around it, unless it is a known kind of digest or identifier. Letters
alone have a lower limit of their own, for long compound words have few characters per token too, and a part of a run that
holds nothing else is judged as one. Digits alone are numbers.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

from pyspark.sql import DataFrame

from ratewright.llm.text import as_text, id_type, map_rows, numbered_columns

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}+")  # shorter runs are no match, and runs are never cut

LEAST = 20  # characters of a random string
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}+")
SEPARATORS = "=/_-"  # between the parts of a run; they say nothing about the stretch they stand in
PART = re.compile(rf"[^{SEPARATORS}]+")
MIXED = re.compile(r"(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])")
IDENTIFIER = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[0-9A-Fa-f]+")
DIGESTS = (32, 40, 56, 64, 96, 128)  # hex digits of the usual digests
KNOWN = re.compile(
    r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|"
    + "|".join(f"[0-9A-Fa-f]{{{n}}}" for n in DIGESTS)
    + r")(?![0-9A-Za-z])"
)
CHARS_PER_TOKEN = 2.2
LETTERS_PER_TOKEN = 2.0  # of letters alone


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(2)
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_looking(value: str, path: str, most: float = CHARS_PER_TOKEN) -> bool:
    if value.isascii() and value.isalpha():
        most = min(most, LETTERS_PER_TOKEN)
    elif not MIXED.match(value):
        return False
    if IDENTIFIER.fullmatch(value) and (len(value) in DIGESTS or "-" in value):
        return False
    return len(value) < most * len(encoder(path).encode_ordinary(value))


def _letter_parts(value: str, path: str, most: float) -> list[tuple[int, int]]:
    """The parts of letters alone that look random."""
    parts = (m.span() for m in PART.finditer(value) if len(m.group()) >= LEAST and m.group().isalpha())
    return [(a, b) for a, b in parts if random_looking(value[a:b], path, most)]


def _windows(value: str, path: str, most: float) -> list[tuple[int, int]]:
    """The parts of ``value`` between separators that a stretch of tokens with LEAST characters and few of them per
    token touches, from the first to the last it touches. Separators count neither as characters nor as tokens."""
    coder = encoder(path)
    sizes = [len(coder.decode_single_token_bytes(t)) for t in coder.encode_ordinary(value)]
    starts = [0]
    for n in sizes:
        starts.append(starts[-1] + n)
    chars = [n - sum(value.count(c, a, a + n) for c in SEPARATORS) for a, n in zip(starts, sizes)]
    parts = [m.span() for m in PART.finditer(value)]
    found: list[tuple[int, int]] = []
    end = held = tokens = k = 0  # the stretch from token i up to ``end``
    for i, n in enumerate(chars):
        while held < LEAST and end < len(chars):
            held, tokens, end = held + chars[end], tokens + (chars[end] > 0), end + 1
        if held < LEAST:
            break
        a, b = starts[i], starts[end]
        if n and held < most * tokens and MIXED.match(value[a:b]):
            while parts[k][1] <= a:
                k += 1
            last = k
            while last + 1 < len(parts) and parts[last + 1][0] < b:
                last += 1
            a, b = parts[k][0], parts[last][1]
            if found and a < found[-1][1]:
                found[-1] = (found[-1][0], max(b, found[-1][1]))
            else:
                found.append((a, b))
        held, tokens = held - n, tokens - (n > 0)
    return found


def random_stretches(run: str, path: str, most: float = CHARS_PER_TOKEN) -> list[tuple[int, int]]:
    """(start, end) of what looks random in ``run``: all of it, or parts; digests and identifiers in it are left out."""
    found, at = [], 0
    for a, b in [*(m.span() for m in KNOWN.finditer(run)), (len(run), len(run))]:
        piece = run[at:a]
        if len(piece) >= LEAST:
            spans = []
            if MIXED.match(piece):
                spans = [(0, len(piece))] if random_looking(piece, path, most) else _windows(piece, path, most)
            apart = [s for s in _letter_parts(piece, path, most) if not any(s[0] < y and x < s[1] for x, y in spans)]
            spans = sorted(spans + apart)
            found += [(at + x, at + y) for x, y in spans if not IDENTIFIER.fullmatch(piece, x, y) or y - x not in DIGESTS]
        at = b
    return found


def find(text: str, path: str, most: float = CHARS_PER_TOKEN) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed. What a base span covers of a run is left to that span, the
    rest of the run is looked at."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = sorted((a, b) for _, a, b in spans)
    k, reach = 0, 0
    for m in RUN.finditer(text):
        a, b = m.span()
        at = max(a, reach)
        rest = []
        while k < len(base) and base[k][0] < b:
            rest.append((at, base[k][0]))
            reach, k = max(reach, base[k][1]), k + 1
            at = max(at, reach)
        for x, y in (*rest, (at, b)):
            if y - x >= LEAST:
                spans += [("random", x + c, x + d) for c, d in random_stretches(text[x:y], path, most)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, path: str | None = None, chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text): doc_id, a count per base kind, base_sha256 over
    the base spans and all spans as ``kind:start:end``. ``path`` names the vocabulary file.

    NULL and empty texts have no spans; repeated rows each give a row; an empty table gives none.
    """
    path = path or vocabulary()
    counts = ", ".join(f"n_{k} long" for k in BASE)
    schema = f"doc_id {id_type(docs)}, {counts}, base_sha256 string, spans string"

    def run(slabs):
        for ids, texts in slabs:
            found = [find(t, path, chars_per_token) for t in as_text(texts)]
            base = [[s for s in spans if s[0] in BASE] for spans in found]
            yield {
                "doc_id": ids,
                **{f"n_{k}": [sum(s[0] == k for s in spans) for spans in base] for k in BASE},
                "base_sha256": [hashlib.sha256(joined(s).encode()).hexdigest() for s in base],
                "spans": [joined(s) for s in found],
            }

    return map_rows(docs, ["doc_id", "text"], schema, run)


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    parts, at = [], 0
    for _, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            parts += [text[at:a], mark]
        at = b
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, path: str | None = None, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans by one mark) and n_chars counted
    again, if there is such a column, where the text changed. Other columns, NULL texts and clean texts stay as they are."""
    path = path or vocabulary()
    names = docs.columns

    def batches(source):
        import pyarrow as pa

        at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None
        for batch in source:
            texts = batch.column(at).to_pylist()
            sizes = batch.column(size).to_pylist() if size is not None else [None] * len(texts)
            for i, text in enumerate(texts):
                if text and (spans := find(text, path)):
                    texts[i] = redacted(text, spans, mark)
                    sizes[i] = len(texts[i])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, type=columns[at].type)
            if size is not None:
                columns[size] = pa.array(sizes, type=columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return numbered_columns(docs).mapInArrow(batches, docs.schema)
