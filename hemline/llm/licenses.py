"""License scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies
them.

For each template length, windows of that length start every quarter of it. The bands are set so that a window
at the least favourable place over a text that just passes the check shares a band with its template with
probability ``RECALL``. Only windows are hashed that could pass the check at all: the places of shingles of a length's templates, in the
window and the stride around it, are as many as the check asks for; that loses nothing. A window is worked out once per text piece
whatever often its words come again. A retrieved template matches if at least ``SIMILARITY`` of its distinct shingles
are, word for word, in the window and the stride around it. Matches of one template that overlap are one
occurrence.

Words are runs of digits, letters (A-Z in lower case) and characters beyond ASCII; shingles have five words,
or all words of a template with fewer. Null and empty texts match nothing, and templates without words are
ignored. Repeated rows repeat their result. Templates are few (at most ``MOST_TEMPLATES``) and go to the
executors inside the task. Those of the package are the notices below and the whole licenses in ``license_texts``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from hemline.llm.common import LOWER_ASCII, Index, Rolling, append_columns, class_runs, mixed, read_table, run_hashes

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
ROWS = 2
MOST_TEMPLATES = 5_000

# Names and wordings of common notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met:",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
    "in compliance with the License. You may obtain a copy of the License at",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
    "was not distributed with this file, You can obtain one at",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
}

TEXTS = Path(__file__).parent / "license_texts"

_LOWER = np.frombuffer(LOWER_ASCII, np.uint8)
_INSIDE = np.array([b >= 0x80 or chr(b).isascii() and chr(b).isalnum() for b in range(256)])
_SHINGLES = Rolling(31)


def known_templates() -> dict[str, str]:
    """The notices, and the files of ``license_texts`` under their names; a whole license is ``<name>-text`` where a notice has its name."""
    made = dict(TEMPLATES)
    for path in sorted(TEXTS.glob("*.txt")):
        made[f"{path.stem}-text" if path.stem in made else path.stem] = path.read_text(encoding="utf-8")
    return made


@dataclass(frozen=True)
class Template:
    name: str
    size: int
    shingles: frozenset
    words: frozenset

    @property
    def stride(self) -> int:
        return max(1, len(self.shingles) // 4)


def band_count(n_shingles: int, stride: int, similarity: float, recall: float, rows: int = ROWS) -> int:
    """Bands so that the nearest window over a text that just passes is retrieved with probability ``recall``."""
    missing, aside = (1 - similarity) * n_shingles, stride / 2
    least = max(0.05, (n_shingles - missing - aside) / (n_shingles + missing + aside))
    return max(8, math.ceil(math.log(1 - recall) / math.log(1 - least**rows)))


def _hashed(data: np.ndarray, offsets: np.ndarray):
    lowered = _LOWER[data]
    starts, ends, first = class_runs(lowered, offsets, _INSIDE)
    return lowered, starts, ends, first, run_hashes(lowered, starts, ends)


def _shingle_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    at = np.arange(max(0, len(tokens) - size + 1))
    return _SHINGLES.ranges(_SHINGLES.prefix(tokens), at, at + size)


class Library:
    """Templates with their band tables, by number of words."""

    def __init__(self, templates: dict[str, str], size: int, similarity: float, recall: float):
        if len(templates) > MOST_TEMPLATES:
            raise ValueError(f"more than {MOST_TEMPLATES} templates")
        self.similarity, by_words = similarity, defaultdict(list)
        for name, text in templates.items():
            raw = np.frombuffer(text.encode(), np.uint8)
            lowered, starts, ends, _, tokens = _hashed(raw, np.array([0, len(raw)]))
            n, k = len(tokens), min(size, len(tokens))
            if n:
                words = [lowered[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                exact = frozenset(tuple(words[i : i + k]) for i in range(n - k + 1))
                own = frozenset(_shingle_hashes(tokens, k).tolist())
                by_words[n, k].append(Template(name, n, own, exact))
        self.classes = []
        for (n, k), own in sorted(by_words.items()):
            m = n - k + 1
            stride = max(1, m // 4)
            bands = band_count(m, stride, similarity, recall)
            multipliers = np.random.default_rng([31, n]).integers(1, 1 << 62, bands * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            table = defaultdict(set)
            for i, t in enumerate(own):
                for key in self.keys(np.array(sorted(t.shingles), np.uint64), multipliers):
                    table[key].add(i)
            index = Index(np.unique(np.array([h for t in own for h in t.shingles], np.uint64)))
            least = min(math.ceil(similarity * len(t.words) - 1e-9) for t in own)
            self.classes.append((n, k, stride, multipliers, dict(table), own, index, least))

    @staticmethod
    def keys(shingles: np.ndarray, multipliers: np.ndarray) -> list[tuple]:
        low = mixed(shingles[:, None] * multipliers[None, :]).min(axis=0).reshape(-1, ROWS)
        return [(band, *row) for band, row in enumerate(low.tolist())]

    def find(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[str, int, int, float]]]:
        """(name, first word, one beyond the last, containment) of each occurrence, per text."""
        lowered, starts, ends, first, tokens = _hashed(data, offsets)
        found = [defaultdict(list) for _ in range(len(first) - 1)]
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        hashes = {k: _shingle_hashes(tokens, k) for k in {c[1] for c in self.classes}}
        prefix = _SHINGLES.prefix(tokens)
        for n, k, stride, multipliers, table, own, index, least in self.classes:
            m = n - k + 1
            hit = index.find(hashes[k]) >= 0
            hit &= text[: len(hit)] == text[k - 1 :][: len(hit)]
            seen: dict[tuple[int, int], list] = {}
            for d, a, b, low, high in _windows(hit, text, first, m, k, stride, least):
                wide_a, wide_b = max(low, a - stride), min(b + stride, high - k + 1)
                # Equal words around equal windows give equal results.
                ends_at = np.array([wide_b + k - 1])
                content = (int(_SHINGLES.ranges(prefix, np.array([wide_a]), ends_at)[0]), a - wide_a, b - wide_a, wide_b - wide_a)
                if content not in seen:
                    picked = {i for key in self.keys(np.unique(hashes[k][a:b]), multipliers) for i in table.get(key, ())}
                    seen[content] = self._verified(picked, own, lowered, starts, ends, wide_a, wide_b, k)
                for name, begin, end, share in seen[content]:
                    found[d][name].append((wide_a - low + begin, wide_a - low + end, share))
        return [sorted(_merged(x), key=lambda r: (r[1], r[2], r[0])) for x in found]


    def _verified(self, picked, own, lowered, starts, ends, a: int, b: int, k: int) -> list[tuple[str, int, int, float]]:
        """(name, first word, one beyond the last, containment) of the picked templates, by words from a."""
        if not picked:
            return []
        words = [lowered[x:y].tobytes() for x, y in zip(starts[a : b + k - 1], ends[a : b + k - 1], strict=True)]
        here = [tuple(words[i : i + k]) for i in range(b - a)]
        out = []
        for i in sorted(picked):
            hits = [p for p, s in enumerate(here) if s in own[i].words]
            share = len({here[p] for p in hits}) / len(own[i].words)
            if share >= self.similarity:
                out.append((own[i].name, hits[0], hits[-1] + k, share))
        return out


def _windows(hit: np.ndarray, text: np.ndarray, first: np.ndarray, m: int, k: int, stride: int, least: int):
    """(text, first and end shingle, the text's first and end word) of the windows that hold a hit and, with the stride on both sides,
    ``least`` hits."""
    at = np.flatnonzero(hit)
    if not len(at):
        return
    local = at - first[text[at]]
    j_low, j_high = np.maximum(0, -(-(local - m + 1) // stride)), local // stride
    span = j_high - j_low + 1
    j = np.repeat(j_low - np.cumsum(span) + span, span) + np.arange(span.sum())
    pairs = np.unique(np.stack([np.repeat(text[at], span), j]), axis=1)
    low, high = first[pairs[0]], first[pairs[0] + 1]
    a = low + pairs[1] * stride
    b = np.minimum(a + m, high - k + 1)
    total = np.concatenate([[0], np.cumsum(hit)])
    around = total[np.minimum(b + stride, high - k + 1)] - total[np.maximum(low, a - stride)]
    for w in np.flatnonzero((around >= least) & (a < b)).tolist():
        yield int(pairs[0][w]), int(a[w]), int(b[w]), int(low[w]), int(high[w])


def _merged(found: dict[str, list[tuple[int, int, float]]]) -> list[tuple[str, int, int, float]]:
    """Occurrences of a template that share words are one."""
    out = []
    for name, spans in found.items():
        for a, b, share in sorted(spans):
            if out and out[-1][0] == name and a < out[-1][2]:
                out[-1] = (name, out[-1][1], max(b, out[-1][2]), max(share, out[-1][3]))
            else:
                out.append((name, a, b, share))
    return out


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    size: int = SHINGLE,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    text: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``n_licenses`` (occurrences), ``licenses`` (names, sorted) and ``license_spans`` per whole text.

    A span is name:first:end in words, end exclusive, by first word. One pass, no shuffle.
    """
    library = Library(known_templates() if templates is None else templates, size, similarity, recall)

    def make(data, offsets):
        found = library.find(data, offsets)
        return {
            "n_licenses": [len(x) for x in found],
            "licenses": [sorted({r[0] for r in x}) for x in found],
            "license_spans": [",".join(f"{r[0]}:{r[1]}:{r[2]}" for r in x) for x in found],
            "license_share": [max((r[3] for r in x), default=0.0) for x in found],
        }

    fields = {
        "n_licenses": "long",
        "licenses": "array<string>",
        "license_spans": "string",
        "license_share": "double",
    }
    return append_columns(docs, text, fields, make, keep_text)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs, keep_text=False).selectExpr(
        "doc_id", "n_licenses", "array_join(licenses, ',') AS licenses", "license_spans", "license_share"
    )
