"""Whole licenses and repeated notices; vectors that share ids, and blocks without a partner."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from hemline.llm import licenses, vectors
from hemline.llm.common import flat_texts


@pytest.fixture(scope="module")
def library():
    return licenses.Library(licenses.known_templates(), 5, 0.8, 0.999)


def found(library, text):
    return [r[0] for r in library.find(*flat_texts(pa.array([text])))[0]]


def test_whole_licenses_are_found_in_changed_copies(library):
    rnd = random.Random(1)
    known = licenses.known_templates()
    assert {"apache-2.0-text", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "mpl-2.0-text", "cc0-1.0", "mit-text", "bsd-2-clause", "zlib", "unlicense", "bsl-1.0", "agpl-3.0-notice"} <= set(known)
    for name, template in known.items():
        words = template.split()
        for _ in range(len(words) // 60):
            words[rnd.randrange(len(words))] = "changed"
        text = f"Some project {' '.join(f'w{rnd.randrange(99)}' for _ in range(300))} {' '.join(words)} and its end."
        assert name in found(library, text), name


def test_families_are_told_apart(library):
    known = licenses.known_templates()
    # One word apart, so both pass the check; the whole match has the higher share.
    shares = {r[0]: r[3] for r in library.find(*flat_texts(pa.array([licenses.TEMPLATES["gpl"]])))[0]}
    assert shares["gpl"] == 1.0 > shares["agpl-3.0-notice"]
    assert "gpl-2.0" not in found(library, known["gpl-3.0"]) and "lgpl-2.1" not in found(library, known["mpl-2.0-text"])
    two, three = known["bsd-2-clause"], known["bsd-2-clause"].replace("THIS SOFTWARE IS PROVIDED", known["bsd-3-clause-names"] + " THIS SOFTWARE IS PROVIDED")
    assert "bsd-3-clause-names" in found(library, three) and "bsd-3-clause-names" not in found(library, two)
    assert "mit-text" not in found(library, known["unlicense"])


def test_a_text_full_of_notices_takes_little_time(library):
    text = (licenses.TEMPLATES["mit"] + " ") * 4000
    data, offsets = flat_texts(pa.array([text]))
    began = time.perf_counter()
    made = library.find(data, offsets)[0]
    assert time.perf_counter() - began < 5 * len(text) / 1e6 + 5
    assert any(r[0] == "mit" for r in made)


def plain_links(rows, threshold=0.9):
    """{position: (links, component)} of rows (id, vector)."""
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in np.flatnonzero(near[i]).tolist():
            a, b = label[i], label[j]
            label = [min(a, b) if k in (a, b) else k for k in label]
    lows = {r: min(rows[i][0] for i in range(len(rows)) if label[i] == r) for r in set(label)}
    return sorted((rows[i][0], int(near[i].sum()) - 1, lows[label[i]]) for i in range(len(rows)))


def test_rows_of_one_id_with_other_vectors_stay_apart(spark):
    rnd = np.random.default_rng(3)
    x, y = np.eye(8)[0], np.eye(8)[1]
    rows = [(1, x), (1, y), (2, x + 0.05), (3, rnd.normal(size=8)), (3, rnd.normal(size=8)), (4, y), (5, -x)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = vectors.near_vectors(df, recall=0.9999)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == plain_links(rows)


@pytest.mark.parametrize("cap", [2, 4, 1024])
def test_small_blocks_count_each_pair_once(spark, cap):
    rnd = np.random.default_rng(5)
    rows = []
    for g in range(40):
        center = rnd.normal(size=16)
        rows += [(5 * g + i, center + rnd.normal(scale=0.01, size=16)) for i in range(5)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = vectors.near_vectors(df, recall=0.9999, cap=cap)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == plain_links(rows)
