"""Terms of texts: maximal runs of term characters, only A-Z lower-cased, as 64-bit hashes with counts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from hemline.llm.common import class_runs, run_hashes

LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Bytes of letters: A-Z, a-z and all that is not ASCII; and of letters and digits.
LETTERS = (LOWER >= 0x61) & (LOWER <= 0x7A) | (LOWER >= 0x80)
ALPHANUMERIC = LETTERS | (LOWER >= 0x30) & (LOWER <= 0x39)


@dataclass(frozen=True)
class TermCounts:
    """Distinct terms of each text of a piece, by text and then by term.

    ``text``, ``term`` and ``count`` have one entry per distinct (text, term); ``term`` points into ``hashes``, whose
    terms are the bytes from ``starts`` to ``ends`` of ``data``. ``total`` has the terms of each text, with repeats.
    """

    text: np.ndarray
    term: np.ndarray
    count: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    total: np.ndarray


def term_counts(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> TermCounts:
    starts, ends, first = class_runs(data, offsets, inside)
    lower = LOWER[data]
    hashes, lead, number = np.unique(run_hashes(lower, starts, ends), return_index=True, return_inverse=True)
    total = np.diff(first)
    keys = np.repeat(np.arange(len(total)), total) * max(len(hashes), 1) + number
    own, count = np.unique(keys, return_counts=True)
    text, term = np.divmod(own, max(len(hashes), 1))
    return TermCounts(text, term, count, hashes, starts[lead], ends[lead], lower, total)
