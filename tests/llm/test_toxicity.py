"""Toxicity features against plain loops, long words, clashing names, near copies; line stage with clashing names."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hemline.llm import line_dedup, toxicity
from hemline.llm.common import flat_texts
from tests.llm import brute
from tests.llm.conftest import SF

PLAIN = re.compile(r"[^\W\d_]+[0-9@$*!]+[^\W\d_]+|[@$0-9]+[^\W\d_]{2,}")
TERMS = toxicity.Terms(frozenset({"zorp", "bla"}), frozenset({"grum", "idio"}))


def test_disguised_spellings_equal_the_plain_expression():
    rnd = random.Random(6)
    for _ in range(30000):
        token = "".join(rnd.choice("aéB1@$*!_-9") for _ in range(rnd.randrange(9)))
        assert toxicity._DISGUISED.findall(token) == PLAIN.findall(token), token


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1" * 1_000_000, "a1" * 500_000, "@" * 1_000_000, "é!" * 300_000, "*" * 1_000_000])
def test_a_long_word_costs_time_in_proportion(text):
    began = time.perf_counter()
    data, offsets = flat_texts(pa.array([text]))
    toxicity.text_features(data, offsets, toxicity.Tokens(TERMS))
    assert time.perf_counter() - began < 15


def plain_features(text):
    """All features of one text, by loops over its tokens and bytes."""
    own, raw = text.split(), text.encode()
    words, size = max(len(own), 1), max(len(raw), 1)

    def parts(token):
        return [w.strip("!*'-_") or w for w in re.findall(r"[^\s.,;:?\"()\[\]{}<>|/\\]+", token.lower())]

    def hidden(token):
        return any(toxicity._undisguised(w.lower()) in toxicity.INSULTS for w in PLAIN.findall(token))

    learned = [any(w in TERMS.words or any(w[:k] in TERMS.stems for k in toxicity.STEMS) for w in parts(t)) for t in own]
    known = [any(w in toxicity.INSULTS for w in parts(t)) for t in own]
    person = [any(w in toxicity.SECOND_PERSON for w in parts(t)) for t in own]
    near = [any(person[max(i - toxicity.NEAR, 0) : i + toxicity.NEAR + 1]) for i in range(len(own))]
    veiled = [hidden(t) for t in own]
    insults = sum(k or v for k, v in zip(known, veiled, strict=True))

    def share(marks):
        return sum(chr(b) in marks for b in raw) / size

    runs = sum(len(m[0]) >= 3 for m in re.finditer(rb"([!?*.#%&$])\1*", raw))
    return [
        sum(learned) / words, np.log1p(sum(learned)), np.log1p(len({t.lower() for t, x in zip(own, learned, strict=True) if x})),
        insults / words, np.log1p(insults), sum(a and b for a, b in zip(known, near, strict=True)) / words,
        sum(a and b for a, b in zip(learned, near, strict=True)) / words, sum(person) / words,
        share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), sum(len(t) > 2 and t.isupper() for t in own) / words, share("!"), share("?"), share(".,;:"),
        runs / words, sum(bool(PLAIN.findall(t)) for t in own) / words, np.log1p(sum(veiled)), share("0123456789"), np.log1p(len(own)),
    ]


def test_features_equal_plain_loops():
    rnd = random.Random(2)
    pool = ["you", "YOUR", "idiot", "1d!ot", "zorp.", "grumble", "Stupid!!!", "a", "M0RON", "été", "???", "...", "12", "du,", "(bla)", "x_y", "ABC"]
    texts = [" ".join(rnd.choice(pool) + rnd.choice(["", "", "!", "\n"]) for _ in range(rnd.randrange(30))) for _ in range(300)] + ["", " "]
    data, offsets = flat_texts(pa.array(texts))
    got = toxicity.text_features(data, offsets, toxicity.Tokens(TERMS))
    for row, text in zip(got.tolist(), texts, strict=True):
        assert row == pytest.approx(plain_features(text)), text


NAMES = ["tox_features", "tox_score", "_tox_raw", "features", "raw", "vector", "probability", "class", "margin", "calibrated", "n_tokens", "n_lines", "n_removed", "kept_text", "copy"]


def test_stages_return_the_columns_they_were_given(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wide = docs.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in NAMES])
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_lines):
        plain = {r["doc_id"]: r for r in stage(spark, docs, SF).collect()}
        made = stage(spark, wide, SF)
        assert made.columns == wide.columns
        rows = made.collect()
        assert {r["doc_id"]: r["text"] for r in rows} == {d: r["text"] for d, r in plain.items()}
        assert all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in NAMES)


def test_near_copies_count_once_however_rows_are_dealt(spark):
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = [(" ".join(base[:30] + [f"c{d}"] + base[31:]), 1, d % 4) for d in range(40)]
    rows += [(" ".join(rnd.choice(base) for _ in range(50)), d % 2, d % 4) for d in range(60)] + [("", 0, 1), (None, 0, 2), ("Two words", 1, 1), ("two WORDS", 1, 0)]
    df = spark.createDataFrame(rows, "text string, toxic int, fold int")
    found = [sorted(map(tuple, toxicity.without_copies(df.repartition(n)).collect()), key=str) for n in (1, 3, 7)]
    assert found[0] == found[1] == found[2]
    assert sum("w59" in (t or "") and "w0 w1 w2" in t for t, *_ in found[0]) <= 6
    assert sum(t is not None and t.lower() == "two words" for t, *_ in found[0]) == 1 and len(found[0]) > 60


def test_copy_keys_are_smallest_hashes_of_word_runs():
    texts = ["a b c d e f", "A b C d", "a b c", "", "x a b c d e f", "a b c d e f a b c d"]
    data, offsets = flat_texts(pa.array(texts))
    keys = toxicity.copy_keys(data, offsets).tolist()
    alone = {t: toxicity.copy_keys(*flat_texts(pa.array([t]))).view(np.uint64)[0] for t in ("a b c d", "b c d e", "c d e f", "x a b c", "d e f a", "e f a b", "f a b c")}
    assert np.uint64(keys[0] & (1 << 64) - 1) == min(alone[t] for t in ("a b c d", "b c d e", "c d e f"))
    assert np.uint64(keys[5] & (1 << 64) - 1) == min(v for t, v in alone.items() if t != "x a b c")
    assert keys[3] == 0 and keys[1] == int(alone["a b c d"].view(np.int64)) and keys[2] not in keys[:2]


def test_long_single_lines_go_and_short_ones_stay(frame):
    line = "this line has five words"
    rows = [(1, f"a\n{line}\nb"), (2, f"c\n{line}\nd\n\nok"), (3, line), (4, f"{line}\n{line} and more"), (5, "ok\nfour words are few\nz"), (6, "y\nfour words are few")]
    want = brute.without_lines(rows, 2)
    got = {(r["doc_id"], r["text"]): (r["n_lines"], r["n_removed"], r["kept_text"]) for r in line_dedup.drop_repeated_lines(frame(rows)).collect()}
    assert got == want
    assert got[3, line] == (1, 1, "") and got[2, rows[1][1]][2] == "c\nd\n\nok" and got[6, rows[5][1]][1] == 0
