"""Operators that compare texts with each other."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hemline.llm import contamination, line_dedup, seeds, simhash, substrings, vectors
from hemline.llm.blocks import block_tasks
from hemline.llm.common import Workspace
from hemline.llm.components import connected, local_roots
from tests.llm import brute
from tests.llm.conftest import SF

CLASH = ("rank", "text_key", "ranges", "n_removed", "component_id", "kept", "words", "hashes", "items", "n_lines")


def test_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(5, i) for i in range(200, 260)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (None, 3), (-4, 9)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected(Workspace(spark, "t"), edges, "a", "b").collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 5 for i in [5, *range(200, 260)]} | {-4: -4, 9: -4}
    assert got == want
    assert connected(Workspace(spark, "t"), edges.limit(0), "a", "b").count() == 0


def test_local_roots_equal_plain_components():
    rnd = np.random.default_rng(4)
    for n in (1, 7, 60):
        a, b = rnd.integers(0, n, (2, n))
        pairs = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
        assert local_roots(n, a, b).tolist() == brute.linked(n, lambda i, j, p=pairs: (i, j) in p)


def test_blocks_meet_every_pair_once_or_in_their_own_block(spark):
    members = spark.range(23).select(F.col("id"), F.lit(1).alias("k")).unionByName(
        spark.range(90, 92).select("id", F.lit(2).alias("k"))
    )
    rows = block_tasks(Workspace(spark, "t"), members, ["k"], "id", 4).collect()
    tasks = {}
    for r in rows:
        tasks.setdefault((r["k"], r["task_a"], r["task_b"]), []).append((r["id"], r["side"]))
    met = {}
    for own in tasks.values():
        two = len({s for _, s in own}) > 1
        for i, s in own:
            for j, t in own:
                if i < j and (s != t if two else True):
                    met[i, j] = met.get((i, j), 0) + 1
    assert set(met.values()) == {1} and len(met) == 23 * 22 // 2 + 1


def test_bit_sliced_pairs_equal_popcounts():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 1 << 63, 40).astype(np.uint64)
    flips = [np.uint64(1) << rnd.integers(0, 64, 40).astype(np.uint64) for _ in range(12)]
    values = np.concatenate([base, base ^ flips[0] ^ flips[1], *[base ^ f ^ g ^ h for f, g, h in zip(flips[::3], flips[1::3], flips[2::3], strict=True)]])
    task = np.sort(rnd.integers(0, 5, len(values)))
    for radius in (0, 2, 4, 7):
        got = {(int(a), int(b)) for i, j in simhash.near_pairs(values, task, radius) for a, b in zip(i, j, strict=True)}
        n = len(values)
        want = {
            (i, j)
            for i in range(n)
            for j in range(i + 1, n)
            if task[i] == task[j] and bin(int(values[i]) ^ int(values[j])).count("1") <= radius
        }
        assert got == want


@pytest.mark.parametrize("n", [10, 10**6, 10**8, 10**11])
def test_tables_miss_no_pair(n):
    rnd = random.Random(n)
    masks = simhash.tables(n, 4)
    for _ in range(300):
        diff = sum(1 << b for b in rnd.sample(range(64), 4))
        assert any(diff & m == 0 for m in masks)


def test_simhash_query_on_whole_table(spark, sample):
    want = brute.near_copies(sample)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op9_simhash(spark, SF).collect()}
    assert got == {d: v for (d, _), v in want.items()}


def test_simhash_of_odd_rows_and_small_blocks(frame, odd_rows, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_CAP", 2)
    rnd = random.Random(8)
    near = [f"n{i} " + " ".join(f"t{j}" for j in range(300)) for i in range(12)]
    rows = [*odd_rows, *[(20 + i, t) for i, t in enumerate(near)], (40, rnd.choice(near))]
    want = brute.near_copies(rows)
    docs = frame(rows, *CLASH, "fingerprint_bits")
    found = simhash.near_copies(docs).collect()
    assert len(found) == len(rows)
    keys = {(r["doc_id"], r["text_key"]): r for r in found}
    texts = {(r["doc_id"], r["k"]): r["text"] for r in docs.select("doc_id", "text", F.xxhash64("text").alias("k")).collect()}
    for key, r in keys.items():
        print_, component = want[key[0], texts[key]]
        assert (f"{r['fingerprint_bits'] & (1 << 64) - 1:016x}", r["component_id"]) == (print_, component)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted({r["doc_id"] for r in kept.collect()}) == sorted({v[1] for v in want.values()})
    assert simhash.near_copies(frame([])).count() == 0


def repeats(rnd, n):
    passages = [[f"p{k}w{i}" for i in range(rnd.randint(30, 90))] for k in range(6)]
    rows = []
    for d in range(n):
        words = []
        for _ in range(rnd.randint(0, 4)):
            own = rnd.choice(passages)
            low = rnd.randrange(len(own))
            words += own[low : low + rnd.randint(1, 90)] + [f"u{rnd.randrange(30)}" for _ in range(rnd.randint(0, 20))]
        rows.append((rnd.randrange(n), " ".join(words)))
    return rows


@pytest.mark.parametrize("window,anchor", [(12, 3), (5, 5), (3, 1)])
def test_repeated_words_equal_all_windows(frame, odd_rows, window, anchor):
    rows = [*odd_rows, *[(100 + d, t) for d, t in repeats(random.Random(window), 60)]]
    docs = frame(rows, *CLASH)
    found = substrings.drop_repeated_words(docs, window, anchor).collect()
    want = brute.without_words(rows, window)
    assert len(found) == len(rows)
    for r in found:
        assert (r["n_tokens"], r["n_removed"], r["kept_text"]) == want[r["doc_id"], r["text"]]
    assert any(v[1] and v[1] < v[0] for v in want.values())


def test_substring_query_on_whole_table(spark, sample):
    want = brute.without_words(sample, 50)
    got = {r["doc_id"]: r for r in substrings.op5_substring_dedup(spark, SF).collect()}
    for (d, _), (n, gone, kept) in want.items():
        assert (got[d]["n_words"], got[d]["n_removed"], got[d]["kept_sha256"]) == (n, gone, brute.digest(kept))


@pytest.mark.parametrize("window", [1, 2, 3])
def test_repeated_lines_equal_all_runs(frame, window):
    rnd = random.Random(window)
    rows = [(d, "\n".join(rnd.choice("abcdefg ") for _ in range(rnd.randint(1, 9)))) for d in range(50)]
    rows += [(60, None), (61, ""), (61, ""), (None, "a\nb\nc"), (62, "x\nx\nx\nx"), (63, "\n\n\n")]
    docs = frame(rows, "kept_text", "n_tokens", "_rank")
    found = line_dedup.drop_repeated_lines(docs, window).collect()
    want = brute.without_lines(rows, window)
    assert len(found) == len(rows)
    for r in found:
        assert (r["n_lines"], r["n_removed"], r["kept_text"]) == want[r["doc_id"], r["text"]]


def test_line_query_on_whole_table(spark, sample):
    want = brute.without_lines(sample, line_dedup.MIN_LINES)
    for r in line_dedup.op10_line_dedup(spark, SF).collect():
        n, gone, kept = next(v for (d, _), v in want.items() if d == r["doc_id"])
        assert (r["n_lines"], r["n_removed"]) == (n, gone)
        assert r["kept_sha256"] == (None if kept is None else brute.digest(kept))


def test_a_full_bit_table_changes_nothing(frame, monkeypatch):
    monkeypatch.setattr(seeds, "FILTER_BITS", 1 << 10)
    rows = repeats(random.Random(9), 40)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    want = brute.without_words(rows, 6)
    for r in substrings.drop_repeated_words(frame(rows), 6, 2).collect():
        assert (r["n_tokens"], r["n_removed"], r["kept_text"]) == want[r["doc_id"], r["text"]]


def test_sliding_minima():
    values = np.random.default_rng(2).integers(0, 99, 50)
    for width in (1, 2, 3, 7, 8, 41, 50):
        assert seeds.sliding_min(values, width).tolist() == [min(values[i : i + width]) for i in range(51 - width)]


def test_empty_tables(frame, spark):
    none = frame([])
    assert substrings.drop_repeated_words(none).count() == 0
    assert line_dedup.drop_repeated_lines(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert contamination.find_contamination(none, items).count() == 0
    some = contamination.find_contamination(frame([(1, "a b"), (2, None)]), items)
    assert sorted(tuple(r) for r in some.select("doc_id", "n_words", "n_hit", "contaminated").collect()) == [
        (1, 2, 0, False),
        (2, 0, 0, False),
    ]


ITEMS = [
    (1, " ".join(f"b{i}" for i in range(20))), (2, "Short ITEM é"), (3, None), (4, ""), (5, "!!"), (2, "short item É"),
    (None, "no name here"), (6, " ".join(f"b{i}" for i in range(5, 25))), (7, "short item é"),
]


@pytest.mark.parametrize("most_grams", [100_000, 0])
def test_contamination_equals_all_windows(frame, spark, odd_rows, most_grams):
    rnd = random.Random(6)
    words = [f"b{i}" for i in range(25)]
    rows = [*odd_rows, (30, "SHORT-item, é"), (31, "short item É"), (32, "no name. here"), (33, "x " * 300 + "short item é")]
    for d in range(40, 80):
        low = rnd.randrange(12)
        parts = [f"z{rnd.randrange(9)}" for _ in range(rnd.randint(0, 200))]
        rows.append((d, " - ".join([*parts, *words[low : low + rnd.randint(8, 16)], *parts[:5]])))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = contamination.find_contamination(frame(rows, *CLASH), items, most_grams=most_grams)
    want = brute.contamination(rows, ITEMS)
    keyed = frame(rows).select("doc_id", "text", F.xxhash64("text").alias("k")).collect()
    texts = {(r["doc_id"], r["k"]): r["text"] for r in keyed}
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        n, hit, own, share = want[r["doc_id"], texts[r["doc_id"], r["text_key"]]]
        assert (r["n_words"], r["n_hit"], r["contaminated"]) == (n, sum(hit), share)
        assert set(r["items"]) == {str(x) for x in own}
        covered = {k for x in r["ranges"] or [] for k in range(x["first"] - 1, x["last"])}
        assert covered == {k for k, h in enumerate(hit) if h}
    assert any(v[3] for v in want.values()) and any(sum(v[1]) and not v[3] for v in want.values())


def test_contaminated_documents_or_spans_go(frame, spark, odd_rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [*odd_rows, (30, "Short item, é"), (31, "x " * 100 + "SHORT item é! And more"), (32, "xshort item é")]
    docs = frame(rows, *CLASH)
    left = contamination.drop_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == len(rows) - 1
    cut = {r["doc_id"]: r["text"] for r in contamination.cut_contamination(docs, items).collect() if r["doc_id"]}
    assert cut[30] == " " and cut[31] == "x " * 100 + " ! And more" and cut[32] == "xshort item é"
    assert cut[6] == dict(rows)[6] and cut[1] is None


def test_contamination_query_runs_no_python(spark):
    plan = contamination.op8_decontamination(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_contamination_query_on_whole_table(spark, sample):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute.contamination(sample, items)
    for r in contamination.op8_decontamination(spark, SF).collect():
        n, hit, own, share = next(v for (d, _), v in want.items() if d == r["doc_id"])
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, sum(hit), len(own), share)
        assert r["items_sha256"] == brute.digest(",".join(sorted(map(str, own))))


def clouds(rnd, groups, size, length):
    rows = []
    for _ in range(groups):
        center = rnd.standard_normal(length)
        for _ in range(rnd.integers(1, size)):
            rows.append(center + 0.28 * rnd.standard_normal(length) * np.linalg.norm(center) / np.sqrt(length))
    return [[float(x) for x in r] for r in rows]


@pytest.mark.parametrize("cap", [1024, 6])
def test_vector_links_equal_all_pairs(spark, cap):
    rnd = np.random.default_rng(3)
    own = clouds(rnd, 40, 16, 24)
    odd = [None, [], [0.0] * 24, [1.0] + [None] * 23, [float("nan")] * 24, [float("inf")] * 24, own[0], own[0], [-0.0] * 23 + [1.0], [0.0] * 23 + [1.0], [2.0, 1.0], [4.0, 2.0]]
    rows = list(enumerate([*own, *odd]))
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, kept string")
    got = {r["vec_id"]: r for r in vectors.near_vectors(table, recall=0.999, cap=cap).collect()}
    want = brute.vector_links(rows, 0.9)
    total, found = sum(v[0] for v in want.values()), sum(r["n_links"] for r in got.values())
    assert len(got) == len(rows) and 0.99 * total <= found <= total
    assert all(got[i]["n_links"] <= want[i][0] for i in got)
    if found == total:
        assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_rows_without_ids_link_too(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.01]), (3, [1.0, 0.02]), (None, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(table).collect()), key=str)
    assert got == [(0, 0, None, False), (0, 2, 3, False), (0, 2, 3, False), (3, 2, 3, True)]
