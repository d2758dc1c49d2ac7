"""License scans by patience alignment.

Words unique to both text and template are anchors; the longest increasing run of anchors fixes the
alignment, and the gaps between them are aligned the same way. A gap without anchors falls back to the
longest common subsequence over its equal words. Coverage is the share of template words
aligned within one compact stretch of the text.

Licenses differ in few words, which a share of all words outvotes. So the words that tell them apart decide: a stretch
is no notice of a license if a name or version word of the template is not aligned, or if a name word that is not the
template's stands in it (Lesser, ShareAlike).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import DataFrame

from ratewright.llm.text import as_text, id_type, map_rows

# The usual notices of public licenses, and the words that tell licenses apart.
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Released under the BSD License.",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-4.0-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-4.0-text": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-sa-4.0-text": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-4.0-text": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal Public Domain Dedication.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
NAMES = frozenset(
    "affero apache attribution bsd cc cc0 commons creative domain gnu gpl isc lesser lgpl library mit mozilla nc nd "
    "noderivatives noderivs noncommercial sa sharealike zero".split()
)
FORMS = ("-header", "-text")  # after a license's name: another notice of it
COVERAGE = 0.8
GAP = 6  # words that may stand between two aligned words of one notice

TOKEN = re.compile(r"[a-z0-9]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else text.translate(LOWER)  # offsets must hold


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run with both numbers rising; ``pairs`` come by first number, equal ones by falling second."""
    tails: list[int] = []
    heads: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        before[i] = heads[k - 1] if k else -1
        tails[k : k + 1] = [b]
        heads[k : k + 1] = [i]
    run, i = [], heads[-1] if heads else -1
    while i >= 0:
        run.append(pairs[i])
        i = before[i]
    return run[::-1]


def align(template: list[str], text: list[str]) -> list[tuple[int, int]]:
    """Aligned (template, text) places, both rising."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(text))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == text[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        wanted = Counter(template[a:b])
        places: dict[str, list[int]] = {}
        for j in range(c, d):
            if text[j] in wanted:
                places.setdefault(text[j], []).append(j)
        anchors = _increasing(
            [(i, places[w][0]) for i in range(a, b) if wanted[w := template[i]] == 1 and len(places.get(w, ())) == 1]
        )
        if not anchors:
            found += _increasing([(i, j) for i in range(a, b) for j in reversed(places.get(template[i], ()))])
            continue
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        found += anchors
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:])]
    return sorted(found)


def compact(aligned: list[tuple[int, int]], gap: int = GAP) -> list[tuple[int, int]]:
    """The largest part of an alignment without a hole of more than ``gap`` words in the text."""
    best: list[tuple[int, int]] = []
    part: list[tuple[int, int]] = []
    for pair in aligned:
        if part and pair[1] - part[-1][1] > gap + 1:
            part = []
        part.append(pair)
        best = max(best, part, key=len)
    return best


@lru_cache(4)
def _prepared(items: tuple[tuple[str, str], ...]):
    return [(name, w, Counter(w)) for name, text in items if (w := TOKEN.findall(text.lower()))]


def find(
    text: str, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE
) -> list[tuple[str, float, int, int]]:
    """(license, coverage, start, end) of each template aligned at ``coverage`` or more, its best stretch, by name;
    offsets in code points."""
    return [stretches[0] for stretches in find_all(text, templates, coverage)]


def find_all(
    text: str, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE
) -> list[list[tuple[str, float, int, int]]]:
    """Of each such template all stretches that do not overlap, the best first. A template whose words
    cannot reach the coverage, or that has a deciding word the text lacks, is not aligned at all."""
    low = lowered(text)
    present = Counter(TOKEN.findall(low))
    found = []
    spans: list[tuple[int, int]] | None = None
    for name, template, wanted in _prepared(tuple(templates.items())):
        if sum(min(n, present[w]) for w, n in wanted.items() if w in present) < coverage * len(template):
            continue
        if any(present[w] < n for w, n in wanted.items() if decides(w)):
            continue
        if spans is None:
            matches = list(TOKEN.finditer(low))
            spans, tokens = [m.span() for m in matches], [m.group() for m in matches]
        parts = _apart(_stretches(template, wanted, tokens, present, coverage))
        if not parts:
            continue
        found.append([(name, len(p) / len(template), spans[p[0][1]][0], spans[p[-1][1]][1]) for p in parts])
    return found


def decides(word: str) -> bool:
    return word in NAMES or word.isdigit()


def _decided(template: list[str], tokens: list[str], part: list[tuple[int, int]]) -> bool:
    """Every deciding word of the template is aligned, and no other name stands between the aligned words."""
    own = {i for i, _ in part}
    if any(i not in own for i, w in enumerate(template) if decides(w)):
        return False
    places = {j for _, j in part}
    return not any(tokens[j] in NAMES for j in range(part[0][1], part[-1][1] + 1) if j not in places)


def _apart(parts: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """The longest, then the longest of those that overlap none before, and so on."""
    kept: list[tuple[int, int]] = []  # ascending, apart
    out = []
    for part in sorted(parts, key=len, reverse=True):
        a, b = part[0][1], part[-1][1]
        at = bisect_left(kept, (a, b))
        if (at == 0 or kept[at - 1][1] < a) and (at == len(kept) or b < kept[at][0]):
            kept.insert(at, (a, b))
            out.append(part)
    return out


def _places(template, wanted, tokens, present, coverage) -> tuple[list[int], int]:
    """Where to look, and how far around.

    A stretch that reaches the coverage misses few template words, so it holds one of the rarest, as many as may be
    missed and one more; only the surroundings of their places are aligned.
    """
    missed, rare = len(template) - coverage * len(template), set()
    for w in sorted(wanted, key=lambda w: (present[w], w)):
        rare.add(w)
        missed -= wanted[w]
        if missed < 0:
            break
    return [j for j, w in enumerate(tokens) if w in rare], len(template) * (GAP + 1)


def _aligned(template, tokens, low: int, high: int) -> list[tuple[int, int]]:
    return [(i, j + low) for i, j in compact(align(template, tokens[low:high]))]


def _stretches(template, wanted, tokens, present, coverage) -> list[list[tuple[int, int]]]:
    """Compact alignments that reach the coverage and are decided, around each place; where a better one stands beside the
    place, also what is left on the place's side of it."""
    places, reach = _places(template, wanted, tokens, present, coverage)
    found, covered = [], -1
    for at in places:
        if at <= covered:
            continue
        low, high = max(0, at - reach), min(len(tokens), at + reach)
        while len(part := _aligned(template, tokens, low, high)) >= max(1, coverage * len(template)):
            if _decided(template, tokens, part):
                found.append(part)
            if part[-1][1] < at:
                low = part[-1][1] + 1
            elif part[0][1] > at:
                high = part[0][1]
            else:
                covered = part[-1][1]
                break
    return found


def license_of(template: str) -> str:
    """The license whose notice a template is."""
    return next((template.removesuffix(f) for f in FORMS if template.endswith(f)), template)


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text): doc_id, n_licenses (a header and a short notice of one license
    count once), license (of the notice with the best coverage, then the longest, then by name; NULL if none), coverage
    (0 if none), and spans, all of them as ``template:start:end`` by name and start, a template as often as its
    notice stands in the text. Where notices contain each other (a header opens with its short form) both are spans.

    NULL and empty texts have none; repeated rows each give a row; an empty table gives none.
    """
    templates = dict(templates)
    schema = f"doc_id {id_type(docs)}, n_licenses long, license string, coverage double, spans string"

    def run(slabs):
        for ids, texts in slabs:
            every = [find_all(t, templates, coverage) for t in as_text(texts)]
            found = [[stretches[0] for stretches in e] for e in every]
            best = [min(f, key=lambda x: (-x[1], x[2] - x[3], x[0])) if f else (None, 0.0) for f in found]
            yield {
                "doc_id": ids,
                "n_licenses": [len({license_of(x[0]) for x in f}) for f in found],
                "license": [b[0] and license_of(b[0]) for b in best],
                "coverage": [b[1] for b in best],
                "spans": [",".join(f"{n}:{a}:{b}" for f in e for n, _, a, b in sorted(f, key=lambda x: x[2])) for e in every],
            }

    return map_rows(docs, ["doc_id", "text"], schema, run)
