"""License scan: winnowed fingerprints find candidates, banded alignment measures them.

Every template is cut into three-word grams, of which each window of three keeps the least hash;
an inverted index leads from these to (template, place). A document is winnowed the same way, so
any five words in a row that it shares with a template meet in the index. Each candidate is
aligned with its template in a band around the diagonal of the shared gram. Aligned pieces that
stand in order, none further than 32 words from the one before, count together: words put in or
left out between them cost nothing.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame

from clickloom.llm.text import by_slice

#: Words of a gram, grams of a window, half width of the band, least covered share of a template.
GRAM, WINDOW, BAND, COVERAGE = 3, 3, 6, 0.6
#: Most words of a text between two matched words of one passage.
NEAR = 32
#: Points for equal words, different words, a word left out on either side.
EQUAL, DIFFERENT, GAP = 2, -1, -1

#: The notices by which public licenses are declared.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at"
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version"
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction"
    ),
}

WORD = re.compile(r"[a-z0-9]+")


class Index:
    """Winnowed grams of the templates: hash to (template, place)."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = [WORD.findall(templates[n].lower()) for n in self.names]
        self.ids = {w: i + 1 for i, w in enumerate(sorted({w for t in self.words for w in t}))}
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            grams, picked = winnow(np.array([self.ids[w] for w in words]))
            for at in picked:
                self.places.setdefault(int(grams[at]), []).append((t, int(at)))


def winnow(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes of word numbers and the places kept. A word of no template (0) makes its grams
    the greatest, so that they never hide one that could match."""
    size = len(ids) - GRAM + 1
    if size < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = np.zeros(size, np.uint64)
    known = np.ones(size, bool)
    for i in range(GRAM):
        part = ids[i : i + size].astype(np.uint64)
        grams = (grams ^ part) * np.uint64(0x100000001B3) + np.uint64(zlib.crc32(b"%d" % i))
        grams ^= grams >> np.uint64(31)
        known &= part > 0
    grams = np.where(known, grams, ~np.uint64(0))
    if not known.any():
        return grams, np.zeros(0, np.int64)
    if size <= WINDOW:
        return grams, np.array([int(grams.argmin())])
    views = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    picked = np.unique(views.argmin(1) + np.arange(len(views)))
    return grams, picked[known[picked]]


def align(words: list, template: list, shift: int) -> tuple[int, int, int]:
    """(equal words, first, last + 1) of the best local alignment of ``template`` within BAND of
    the diagonal word = place + ``shift``; first and last count words."""
    pairs = aligned(words, template, shift)
    return (len(pairs), pairs[0][0], pairs[-1][0] + 1) if pairs else (0, 0, 0)


def aligned(words: list, template: list, shift: int) -> list[tuple[int, int]]:
    """(word, place) of the equal words of that alignment, in order."""
    width = 2 * BAND + 1
    best, end = 0, None
    above = [0] * width
    steps = []
    for i, want in enumerate(template):
        row, step = [0] * width, [0] * width
        for k in range(width):
            j = i + shift + k - BAND
            if not 0 <= j < len(words):
                continue
            same = words[j] == want
            options = (
                (0, 0), (above[k] + (EQUAL if same else DIFFERENT), 1),
                (above[k + 1] + GAP if k + 1 < width else 0, 2), (row[k - 1] + GAP if k else 0, 3),
            )
            row[k], step[k] = max(options, key=lambda o: (o[0], o[1] == 1))
            if row[k] > best:
                best, end = row[k], (i, k)
        above = row
        steps.append(step)
    if end is None:
        return []
    (i, k), pairs = end, []
    while i >= 0 and 0 <= k < width and steps[i][k]:
        if steps[i][k] == 1:
            j = i + shift + k - BAND
            if words[j] == template[i]:
                pairs.append((j, i))
            i -= 1
        elif steps[i][k] == 2:
            i, k = i - 1, k + 1
        else:
            k -= 1
    return pairs[::-1]


def pieces(words: list, template: list, shift: int, places: list[int]) -> list[list[tuple[int, int]]]:
    """The alignments on one diagonal that hold shared grams, which start at ``places``, and the
    run of equal words around a gram if a better alignment beside it hides its own."""
    found, open_ = [], [(0, len(template))]
    while open_:
        low, high = open_.pop()
        if any(low <= p and p + GRAM <= high for p in places):
            pairs = aligned(words, template[low:high], shift + low)
            if len(pairs) >= GRAM:
                found.append([(j, i + low) for j, i in pairs])
                open_ += [(low, found[-1][0][1]), (found[-1][-1][1] + 1, high)]
    for p in places:
        if not any((p + shift, p) in piece for piece in found):
            low, high = p, p + 1
            while low and low + shift and words[low + shift - 1] == template[low - 1]:
                low -= 1
            while high < min(len(template), len(words) - shift) and words[high + shift] == template[high]:
                high += 1
            found.append([(i + shift, i) for i in range(low, high)])
    return found


def chains(found: list[list[tuple[int, int]]], size: int) -> list[tuple[int, int, int]]:
    """(first, last + 1, matched words) of passages with at least COVERAGE of ``size`` words.

    A passage takes words of the pieces in the order of text and template, at most NEAR words
    apart. Of all sets of passages that do not overlap, the one with the most matched words is
    taken, among equals one that spans the fewest words.
    """
    points = sorted({pair for piece in found for pair in piece})
    at = [j for j, _ in points]
    made = []
    for start in sorted({piece[0][0] for piece in found}):
        live: list[tuple[int, int, int]] = []
        most = 0
        for j, i in points[bisect_right(at, start - 1):]:
            live = [x for x in live if j - x[0] <= NEAR + 1]
            if j > start and not live:
                break
            before = max((n for y, x, n in live if y < j and x < i), default=0)
            if before or j == start:
                live.append((j, i, before + 1))
                if before + 1 > most:
                    most = before + 1
                    if most / size >= COVERAGE:
                        made.append((j + 1, start, most))
    made.sort()
    ends, best = [m[0] for m in made], [(0, 0, None)]
    for n, (end, start, equal) in enumerate(made):
        rest = bisect_right(ends, start, 0, n)
        taken = (best[rest][0] + equal, best[rest][1] - (end - start), (rest, n))
        best.append(max(best[-1], taken, key=lambda x: x[:2]))
    kept, step = [], best[-1][2]
    while step:
        rest, n = step
        kept.append((made[n][1], made[n][0], made[n][2]))
        step = best[rest][2]
    return kept[::-1]


def scan(text: str | None, index: Index) -> list[tuple[str, float, int, int, int]]:
    """(template, coverage, matched words, first, last + 1 code point) of a text, by template and
    place; matches of a template do not overlap."""
    lower = (text or "").encode("utf-8", "replace").lower().decode()  # A to Z only: same length
    words = WORD.findall(lower)
    ids = np.fromiter((index.ids.get(w, 0) for w in words), np.int64, len(words))
    grams, picked = winnow(ids)
    hits: dict[int, dict[int, list[int]]] = {}
    for at in picked:
        for t, place in index.places.get(int(grams[at]), ()):
            hits.setdefault(t, {}).setdefault(int(at) - place, []).append(place)
    if not hits:
        return []
    kept = []
    for t, diagonals in sorted(hits.items()):
        template = index.words[t]
        found = [p for shift in sorted(diagonals) for p in pieces(words, template, shift, diagonals[shift])]
        kept += [(t, *c) for c in chains(found, len(template))]
    spans = [m.span() for m in WORD.finditer(lower)]
    return [
        (index.names[t], equal / len(index.words[t]), equal, spans[first][0], spans[last - 1][1])
        for t, first, last, equal in kept
    ]


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license, coverage, matched, start, end): one row for each passage of a whole text
    that covers at least 60 % of a template's words.

    ``coverage`` and ``matched`` count the template words that the pieces of a passage match
    together; a piece shows by a shared gram, so by any five shared words in a row, and stands at
    most 32 words behind the one before it. Pieces below 60 % together give no row.
    ``start`` and ``end`` are code points of the text. Words are runs of a-z and 0-9 of the
    text with A to Z lower-cased. Documents without a match, NULL and empty texts give no rows; repeated rows give
    repeated rows; a NULL doc_id stays NULL; other columns are not read. The templates are a
    parameter of a few kilobytes that travels with the job.
    """
    chosen = dict(TEMPLATES if templates is None else templates)

    def make():
        index = Index(chosen)

        def run(ids, texts):
            rows = [(i, *r) for i, t in zip(ids, texts) for r in scan(t, index)]
            return list(zip(*rows)) if rows else [[]] * 6

        return run

    schema = "doc_id bigint, license string, coverage double, matched bigint, start bigint, end bigint"
    return by_slice(docs, ["doc_id", "text"], make, schema)
