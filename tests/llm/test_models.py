"""Toxicity, language-model scores and the pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hemline.llm import suffix_tree, toxicity
from hemline.llm.common import Workspace, flat_texts
from tests.llm import brute
from tests.llm.conftest import SF


def spoken(rnd, toxic):
    words = [rnd.choice(["ka", "lo", "mi", "ren", "sut"]) + rnd.choice(["an", "el", "is", "or"]) for _ in range(rnd.randint(5, 80))]
    if toxic:
        for _ in range(rnd.randint(1, 4)):
            words.insert(rnd.randrange(len(words)), "grumf" + rnd.choice(["a", "en", "ix", "olo"]))
    return " ".join(words)


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(7)
    rows = [(d, spoken(rnd, d % 5 == 0)) for d in range(900)] + [(9000, ""), (9001, None), (None, "kaan")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, tox_score string")
    labels = [(d, 1, int(d % 5 == 0)) for d, _ in rows[:900]] + [(5, 1, 0), (3, 1, None), (None, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return rows, toxicity.score_documents(docs, docs, table).collect()


def test_held_out_texts_are_told_apart(scored):
    rows, found = scored
    assert len(found) == len(rows)
    out = [(r["tox_score"] >= toxicity.THRESHOLD, r["doc_id"] % 5 == 0) for r in found if r["doc_id"] is not None and r["doc_id"] < 900 and brute.held_out(r["doc_id"], 4, 2)]
    assert len(out) > 150 and sum(a == b for a, b in out) >= 0.97 * len(out)
    assert all(0 <= r["tox_score"] <= 1 for r in found)
    assert all(r["tox_score"] < toxicity.THRESHOLD for r in found if not r["text"])


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.createDataFrame([(d, f"t{d}") for d in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(d, d % 2) for d in range(200)], "doc_id long, toxic int")
    used = {r["doc_id"] for r in toxicity.training_rows(docs, labels).collect()}
    assert used == {d for d in range(200) if not brute.held_out(d, 4, 2)}
    assert toxicity.training_rows(docs, labels, 50).count() < 90


def test_without_both_classes_the_share_is_the_score(spark):
    docs = spark.createDataFrame([(d, "a b") for d in range(40)], "doc_id long, text string")
    for labels, share in (([], 0.0), ([(d, 1) for d in range(40)], 1.0)):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert {r["tox_score"] for r in toxicity.score_documents(docs, docs, table).collect()} == {share}
    assert toxicity.score_documents(docs.limit(0), docs, table).count() == 0


def test_toxicity_features_see_disguise_and_person():
    own = toxicity.Tokens(toxicity.Terms(frozenset({"zorp"}), frozenset({"grum"})))
    texts = ["You 1d!ot, st*pid M0RON!!! WHAT", "", "the grumpel zorp. far from here and far from there you", "?? ab 12"]
    data, offsets = flat_texts(pa.array(texts))
    rows = [dict(zip(toxicity.FEATURES, r, strict=True)) for r in toxicity.text_features(data, offsets, own).tolist()]
    assert rows[0]["known_density"] > 0 and rows[0]["exclamations"] > 0 and rows[0]["shouted_words"] > 0
    assert rows[0]["person_density"] == 1 / 5 and rows[0]["repeated_marks"] == 1 / 5
    assert set(rows[1].values()) == {0.0}
    assert rows[2]["learned_density"] == 2 / 11 and rows[2]["learned_near_person"] == 0
    assert rows[2]["learned_distinct"] == pytest.approx(np.log1p(2)) and rows[3]["digit_rate"] == 2 / 8


def test_toxicity_query_on_whole_table(spark, sample):
    got = {r["doc_id"]: r for r in toxicity.op4_toxicity(spark, SF).collect()}
    assert len(got) == len(sample)
    for d, _ in sample:
        assert got[d]["held_out"] == brute.held_out(d, 4, 2)
        assert got[d]["predicted"] == int(got[d]["score"] >= 0.3)


def chain(rnd, n):
    out = ["a"]
    for _ in range(n):
        out.append({"a": "b", "b": "c"}.get(out[-1]) if rnd.random() < 0.9 and out[-1] in "ab" else rnd.choice("abcdefgh"))
    return " ".join(out)


def test_every_state_sums_to_one(spark):
    rnd = random.Random(3)
    docs = spark.createDataFrame([(chain(rnd, 200),) for _ in range(60)], "text string")
    tree, tail = suffix_tree.grow(docs, Workspace(spark, "t"), least_count=5, least_share=1e-9)
    assert tail.count() == 0 and len(tree.levels) >= 3 and tree.levels[0].retained.any()
    names = np.array([*tree.words.keys.tolist(), 123456789])
    for history in ([], ["a"], ["a", "b"], ["c", "a", "b"], ["h", "g", "e"]):
        past = [suffix_tree.tokens(np.frombuffer(h.encode(), np.uint8), np.array([0, 1]))[0][0] for h in history]
        total = 0.0
        for w in names:
            base, value, place = suffix_tree.score_tokens(tree, np.array([*past, w]), np.array([0]))
            root = 0.0 if place[-1] >= 0 else np.log10(0.5) - tree.log_total
            total += 10 ** (value[-1] + root)
        assert total == pytest.approx(1.0, abs=1e-6)


def test_longer_contexts_score_better(spark):
    rnd = random.Random(4)
    docs = spark.createDataFrame([(d, chain(rnd, 150)) for d in range(80)], "doc_id long, text string")
    found = suffix_tree.score_texts(docs, docs.filter("doc_id < 60")).filter("doc_id >= 60").collect()
    assert sum(r["score"] for r in found) > 0.85 * sum(r["base_score"] for r in found)


@pytest.mark.parametrize("head", [1_000_000, 5])
def test_base_scores_equal_plain_counts(spark, frame, odd_rows, sample, head):
    rows = [*odd_rows, *[(d + 1000, t) for d, t in sample[:40]]]
    docs = frame(rows, "n_tokens", "key", "row", "others")
    training = docs.filter(~suffix_tree.held_out(F.col("doc_id")))
    found = suffix_tree.score_texts(docs, training, head=head).collect()
    want = sorted(brute.word_scores([(d, t) for d, t in rows]).items(), key=str)
    assert len(found) == len(rows)
    counted = {}
    for r in found:
        counted.setdefault(r["doc_id"], []).append((r["n_tokens"], r["n_known"], round(r["base_score"], 4)))
        assert np.isfinite(r["score"])
    once = {}
    for (d, t), v in want:
        once[d, t] = v
    # repeated rows count as often as they are there, so only texts told apart by their number of tokens are compared
    assert all(any(c[0] == v[0] for c in counted[d]) for (d, _), v in once.items())


def test_lm_query_on_whole_table(spark, sample):
    want = brute.word_scores(sample)
    for r in suffix_tree.op7_lm_score(spark, SF).collect():
        n, known, total, base = next(v for (d, _), v in want.items() if d == r["doc_id"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == brute.held_out(r["doc_id"], 5, 1)


def test_rare_runs_stay_however_large_the_corpus(spark):
    filler = spark.range(900).selectExpr("id AS doc_id", "repeat('f ', 10000) AS text")
    rare = spark.range(1000, 1006).selectExpr("id AS doc_id", "'brisk umber quartz lantern' AS text")
    asked = spark.createDataFrame([(1, "brisk umber quartz lantern")], "doc_id long, text string")
    (row,) = suffix_tree.score_texts(asked, filler.unionAll(rare)).collect()
    assert row["train_tokens"] > 9_000_000 and row["score"] > row["base_score"] + 10


@pytest.mark.parametrize("settings", [{"head_runs": 0}, {"head_runs": 40, "head": 3}])
def test_scores_do_not_depend_on_the_head(spark, settings):
    rnd = random.Random(6)
    docs = spark.createDataFrame([(d, chain(rnd, 150)) for d in range(60)], "doc_id long, text string")
    want = {r["doc_id"]: r["score"] for r in suffix_tree.score_texts(docs, docs).collect()}
    for r in suffix_tree.score_texts(docs, docs, **settings).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-9)


def test_no_training_text(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = suffix_tree.score_texts(docs, docs.limit(0)).collect()
    assert [r["base_score"] for r in found] == [0.0, 0.0] and {r["n_known"] for r in found} == {0}
    assert suffix_tree.score_texts(docs.limit(0), docs).count() == 0


def test_pipeline_keeps_the_columns_and_equals_plain_stages(spark, sample):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, state = docs.columns, docs
    work = Workspace(spark, "t")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        state = work.write(stage(spark, state, SF), name)
        rows[name] = state
        if name != "sentencepiece":
            assert state.columns == columns
    pairs = {k: [(r["doc_id"], r["text"]) for r in v.collect()] for k, v in rows.items() if k != "sentencepiece"}
    lines = brute.without_lines(pairs["toxicity"], 2)
    assert sorted(pairs["line_dedup"]) == sorted((d, v[2]) for (d, _), v in lines.items())
    copies = brute.near_copies(pairs["line_dedup"])
    assert sorted(pairs["simhash_near_dedup"]) == sorted(k for k, v in copies.items() if v[1] == k[0])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = brute.contamination(pairs["simhash_near_dedup"], items)
    assert sorted(pairs["benchmark_decontamination"]) == sorted(k for k, v in bad.items() if not v[3])
    last = {r["doc_id"]: r["decoded_sha256"] for r in state.collect()}
    assert last == {d: brute.digest(t) for d, t in pairs["benchmark_decontamination"]}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, state.collect()))
