"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, digits, plus signs, URL schemes, street words and account
cues. A local parser at each anchor expands to the boundaries of the value and validates it. Texts
without an anchor cost one automaton pass and nothing else.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from ratewright.llm.text import as_text, id_type, map_rows

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "address", "account")
KINDS = BASE + ADDED

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL = re.compile(r"(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
HOUSE = re.compile(r"[0-9]{1,5}[A-Za-z]? (?:[A-Z][A-Za-z'.-]* ){1,4}$")
ACCOUNT = re.compile(r"(?: (?:[Nn]o|[Nn]umber|NUMBER)\b\.?)?[ ]?[:#]? ?([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}|[0-9]{8,17}(?![0-9]))")

SCHEMES = ("http://", "https://", "ftp://")
STREETS = ("Street", "Avenue", "Road", "Boulevard", "Lane", "Drive", "Way")
CUES = ("IBAN", "iban", "account", "Account", "ACCOUNT", "acct", "Acct")


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, anchors in (
        ("at", "@"), ("plus", "+"), ("digit", "0123456789"),
        ("url", SCHEMES), ("address", STREETS), ("account", CUES),
    ):
        for anchor in anchors:
            found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    """Country, check digits and the remainder by 97; a longer run is cut back by its caller."""
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _account(text: str, at: int) -> tuple[int, int] | None:
    m = ACCOUNT.match(text, at)
    if not m:
        return None
    start, end = m.span(1)
    if text[start].isdigit():
        return start, end
    while end > start:  # words in capitals may follow the number
        compact = text[start:end].replace(" ", "")
        if len(compact) < 15:
            return None
        if iban(compact):
            return start, end
        end -= 1
        while text[end - 1] == " ":
            end -= 1
    return None


def find(text: str) -> dict[str, list[tuple[int, int]]]:
    """(start, end) in code points by kind, in order and without overlap within a kind."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(("email", "ip", "card", *ADDED), 0)  # where the next value of a kind may begin
    for last, (kind, length) in automaton().iter(text):
        at, after = last - length + 1, last + 1
        if kind == "digit":
            if at >= done["ip"]:
                if m := IP.match(text, at):
                    done["ip"] = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.groups()):
                        spans["ip"].append(m.span())
                else:  # no other start within these digits can do better
                    done["ip"] = DIGITS.match(text, at).end()
            if at >= done["card"]:
                if m := CARD.match(text, at):
                    done["card"] = m.end()
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(m.span())
        elif kind == "at":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, after)):
                spans["email"].append((start, m.end()))
                done["email"] = m.end()
        elif kind == "plus":
            if (m := PHONE.match(text, at)) and 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                spans["phone"].append(m.span())
        elif at >= done[kind]:
            if kind == "url":
                if m := URL.match(text, after):
                    spans[kind].append((at, at + len(text[at : m.end()].rstrip(".,;:!?)"))))
            elif kind == "address":
                low = max(done[kind], at - 80)
                word = text[after : after + 1].isalpha()
                if not word and (m := HOUSE.search(text[low:at])):
                    spans[kind].append((low + m.start(), after))
            elif span := _account(text, after):
                spans[kind].append(span)
            if spans[kind]:
                done[kind] = max(done[kind], spans[kind][-1][1])
    return spans


def joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text; others are left aside): doc_id, a count per
    base kind, base_sha256 over the base spans, and all spans as ``kind:start:end``.

    NULL and empty texts have no spans; repeated rows each give a row; an empty table gives none.
    """
    counts = ", ".join(f"n_{k} long" for k in BASE)
    schema = f"doc_id {id_type(docs)}, {counts}, base_sha256 string, spans string"

    def run(slabs):
        for ids, texts in slabs:
            found = [find(t) for t in as_text(texts)]
            yield {
                "doc_id": ids,
                **{f"n_{k}": [len(s[k]) for s in found] for k in BASE},
                "base_sha256": [hashlib.sha256(joined(s, BASE).encode()).hexdigest() for s in found],
                "spans": [joined(s, KINDS) for s in found],
            }

    return map_rows(docs, ["doc_id", "text"], schema, run)
