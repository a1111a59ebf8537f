"""Toxicity: boosted trees over dense features of the text, calibrated by isotonic regression.

Terms (words and word stems) that toxic training texts have much more often than others are learned in folds:
a training text's features come from terms of the other folds, so no term is judged by the text it was learned
from; later texts get the terms of all folds. The trees are grown on three quarters of the labelled rows and
calibrated on the last. Features are densities of learned and of commonly known terms, their nearness to
second-person words, and rates of capitals, punctuation and disguised spelling. Labels, languages, sources and
ids are no features.

At most ``SAMPLE`` labelled rows (about; picked by a hash of the id) are used to fit; scoring reads every
whole text once, without a shuffle. Null texts count as empty and get the score of a text without any feature.
Labels that are null are not used; a document with several labels counts as toxic if one is. Without rows of
both classes the score is the share of toxic rows (0 without rows).
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import reduce
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm.common import (
    Rolling, Workspace, append_columns, free_names, read_table, run_hashes, text_pieces, texts_of, words,
)
from hemline.llm.terms import LOWER

SAMPLE = 40_000
THRESHOLD = 0.3
STEMS = (4, 5, 6)
LEAST_DOCS = 5
FOLDS = 4
LEAST_ODDS = 3.0
NEAR = 4
MOST_TOKENS = 300_000
HELD_TERMS = 150_000
#: Words of the runs by which near copies are told.
COPY_WORDS = 4

# Insults in common use, second-person words, and characters that stand for letters.
INSULTS = [
    "idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "garbage", "worthless", "pathetic", "disgusting",
    "clown", "fool", "hate", "kill", "ugly", "liar", "pig", "freak", "creep", "imbecile", "vermin", "filth",
    "dumm", "trottel", "abschaum", "arschloch", "hure", "mistkerl", "connard", "salope", "ordure", "merde", "abruti",
    "imbécile", "estúpido", "idiota", "basura", "escoria", "mierda", "puta", "gilipollas", "cabrón",
]
SECOND_PERSON = [
    "you", "your", "you're", "yours", "yourself", "u", "ur", "du", "dein", "deine", "dich", "dir", "ihr", "euch", "sie",
    "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "tú", "ti", "tus", "usted", "ustedes", "vos",
]
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

FEATURES = [
    "learned_density", "learned_count", "learned_distinct", "known_density", "known_count", "near_person",
    "learned_near_person", "person_density", "capital_rate", "shouted_words", "exclamations", "questions", "punctuation",
    "repeated_marks", "disguised_rate", "disguised_known", "digit_rate", "length",
]

_WORD = re.compile(r"[^\s.,;:?\"()\[\]{}<>|/\\]+")
# Runs are taken whole and only from their start, so a token costs time in proportion to its length.
_DISGUISED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$*!]++[^\W\d_]++|(?<![@$0-9])[@$0-9]++[^\W\d_]{2,}")
_PLAIN = str.maketrans(DISGUISES)
_KNOWN, _PERSON = frozenset(INSULTS), frozenset(SECOND_PERSON)
_held: dict[str, object] = {}
_COPIES = Rolling(51)


# What a token can be, as bits.
LEARNED, KNOWN, PERSON, DISGUISED, HIDDEN, SHOUTED = (1 << i for i in range(6))


@dataclass(frozen=True)
class Terms:
    """Learned words and stems."""

    words: frozenset
    stems: frozenset


def _words(token: str) -> list[str]:
    return [w.strip("!*'-_") or w for w in _WORD.findall(token.lower())]


def _undisguised(word: str) -> str:
    return re.sub(r"(.)\1{2,}", r"\1", word.translate(_PLAIN).replace("*", "").replace("-", ""))


class Tokens(dict):
    """Bits of tokens between white space, worked out once per distinct token; at most ``MOST_TOKENS`` are held."""

    def __init__(self, terms: Terms):
        super().__init__()
        self.terms = terms

    def __missing__(self, token: str) -> int:
        terms, bits = self.terms, 0
        for w in _words(token):
            if w in terms.words or any(w[:k] in terms.stems for k in STEMS):
                bits |= LEARNED
            bits |= KNOWN * (w in _KNOWN) | PERSON * (w in _PERSON)
        raw = _DISGUISED.findall(token)
        if raw:
            bits |= DISGUISED | HIDDEN * any(_undisguised(w.lower()) in _KNOWN for w in raw)
        if len(token) > 2 and token.isupper():
            bits |= SHOUTED
        if len(self) >= MOST_TOKENS:
            self.clear()
        self[token] = bits
        return bits


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _kinds(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), [ord(c) for c in characters])


_CAPITALS, _DIGITS, _MARKS = _kinds("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _kinds("0123456789"), _kinds("!?*.#%&$")


def text_features(data: np.ndarray, offsets: np.ndarray, known_tokens: Tokens) -> np.ndarray:
    """Features of all texts of a piece, one row per text."""
    own = [t.decode().split() for t in texts_of(data, offsets)]
    counts = np.array([len(x) for x in own])
    flat = list(chain.from_iterable(own))
    bits = np.frombuffer(bytes([known_tokens[t] for t in flat]), np.uint8)
    cuts = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(own)), counts)
    learned, known, person, disguised, hidden, shouted = ((bits & (1 << i)) > 0 for i in range(6))
    near = np.zeros(len(bits), bool)
    for p in np.flatnonzero(person).tolist():
        low, high = max(p - NEAR, int(cuts[text[p]])), min(p + NEAR + 1, int(cuts[text[p] + 1]))
        near[low:high] = True
    distinct = np.zeros(len(own))
    hits = np.flatnonzero(learned).tolist()
    for d, words in groupby(hits, key=lambda i: text[i]):
        distinct[d] = len({flat[i].lower() for i in words})
    words, size = np.maximum(counts, 1), np.maximum(np.diff(offsets), 1)
    mark = _MARKS[data]
    same = np.zeros(len(data), bool)
    same[1:] = mark[1:] & (data[1:] == data[:-1])
    same[offsets[:-1][offsets[:-1] < len(data)]] = False
    third = np.zeros(len(data), bool)
    third[2:] = same[2:] & same[1:-1]
    first_third = third.copy()
    first_third[1:] &= ~third[:-1]

    def tokens(mask: np.ndarray) -> np.ndarray:
        return _per_text(mask, cuts)

    def characters(mask: np.ndarray) -> np.ndarray:
        return _per_text(mask, offsets) / size

    insults = tokens(known | hidden)
    return np.stack(
        [
            tokens(learned) / words,
            np.log1p(tokens(learned)),
            np.log1p(distinct),
            insults / words,
            np.log1p(insults),
            tokens(known & near) / words,
            tokens(learned & near) / words,
            tokens(person) / words,
            characters(_CAPITALS[data]),
            tokens(shouted) / words,
            characters(data == ord("!")),
            characters(data == ord("?")),
            characters(_kinds(".,;:")[data]),
            _per_text(first_third, offsets) / words,
            tokens(disguised) / words,
            np.log1p(tokens(hidden)),
            characters(_DIGITS[data]),
            np.log1p(counts),
        ],
        axis=1,
    )


def with_features(
    docs: DataFrame, terms: Terms, text: str = "text", keep_text: bool = True, name: str = "tox_features"
) -> DataFrame:
    """``docs`` with ``name`` (array of double, in the order of ``FEATURES``); a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def make(data, offsets):
        if _held.get("terms") is not shared.value:
            _held.update(terms=shared.value, tokens=Tokens(shared.value))
        rows = text_features(data, offsets, _held["tokens"])
        ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
        return {name: pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))}

    return append_columns(docs, text, {name: "array<double>"}, make, keep_text)


def learn_terms(sample: DataFrame, folds: int = FOLDS) -> list[Terms]:
    """Terms from (text, toxic, fold): for each fold those of all other folds, and last those of all rows.

    Document counts per class with smoothed odds; every term whose odds reach ``LEAST_ODDS`` in ``LEAST_DOCS`` documents is taken, so
    their number is bounded by the sample alone.
    """

    def run(batches):
        total, seen = defaultdict(Counter), Counter()
        for rows, data, offsets in text_pieces(batches, "text"):
            toxic, fold = (rows.column(rows.schema.get_field_index(c)).to_pylist() for c in ("toxic", "fold"))
            for t, y, f in zip(texts_of(data, offsets), toxic, fold, strict=True):
                words = set(_words(t.decode()))
                if not words:
                    continue
                total[f, y].update(words)
                total[f, y].update({f"{w[:k]}*" for w in words for k in STEMS if len(w) >= k})
                seen[f, y] += 1
            if sum(map(len, total.values())) > HELD_TERMS:
                yield _counted(total)
        for key, n in seen.items():
            total[key][""] += n
        yield _counted(total)

    work = Workspace(sample.sparkSession, "toxic-terms")
    counted = sample.mapInArrow(run, "fold int, term string, toxic long, clean long")
    per_fold = work.write(
        counted.groupBy("fold", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "terms"
    )
    sizes = {r["fold"]: r for r in per_fold.filter("term = ''").collect()}
    found = []
    for left_out in [*range(folds), None]:
        toxic = sum(r["toxic"] for f, r in sizes.items() if f != left_out)
        clean = sum(r["clean"] for f, r in sizes.items() if f != left_out)
        odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
        picked = (
            per_fold.filter(F.lit(True) if left_out is None else F.col("fold") != left_out)
            .filter("term <> ''")
            .groupBy("term")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .filter((F.col("toxic") >= LEAST_DOCS) & (odds >= LEAST_ODDS))
            .select("term")
            .collect()
        )
        terms = [r["term"] for r in picked]
        found.append(
            Terms(
                frozenset(t for t in terms if not t.endswith("*")), frozenset(t[:-1] for t in terms if t.endswith("*"))
            )
        )
    work.drop()
    return found


def copy_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The smallest hash of the runs of ``COPY_WORDS`` lower-cased words of each text, of all its words if they are fewer.

    Two texts have the same one as likely as the share of such runs that they have in common, whatever they have in one place.
    """
    lower = LOWER[data]
    starts, ends, first = words(lower, offsets)
    hashes = run_hashes(lower, starts, ends)
    n, most = np.diff(first), len(hashes)
    prefix, at = _COPIES.prefix(hashes), np.arange(most)
    last = np.repeat(first[1:], n)
    short = np.repeat(n, n) < COPY_WORDS
    runs = _COPIES.ranges(prefix, np.where(short, np.repeat(first[:-1], n), at), np.where(short, last, np.minimum(at + COPY_WORDS, last)))
    whole = short | (at + COPY_WORDS <= last)
    out = np.zeros(len(n), np.uint64)
    filled = np.flatnonzero(n)
    if len(filled):
        out[filled] = np.minimum.reduceat(np.where(whole, runs, np.uint64(0xFFFFFFFFFFFFFFFF)), first[filled])
    return out.view(np.int64)


def without_copies(rows: DataFrame) -> DataFrame:
    """(text, toxic, fold) of one text of each group of likely near copies of a class, the same one however rows fall into tasks."""
    keyed = append_columns(rows.select("text", "toxic", "fold"), "text", {"copy": "long"}, lambda data, offsets: {"copy": copy_keys(data, offsets)})
    first = keyed.groupBy("toxic", "copy").agg(F.min(F.struct("fold", "text")).alias("first"))
    return first.select("first.text", "toxic", "first.fold")


def _counted(total: dict[tuple[int, int], Counter]) -> pa.RecordBatch:
    terms = sorted({(f, t) for (f, _), own in total.items() for t in own})
    made = pa.RecordBatch.from_pydict(
        {
            "fold": pa.array([f for f, _ in terms], pa.int32()),
            "term": pa.array([t for _, t in terms], pa.string()),
            "toxic": pa.array([total[f, 1][t] for f, t in terms], pa.int64()),
            "clean": pa.array([total[f, 0][t] for f, t in terms], pa.int64()),
        }
    )
    total.clear()
    return made


@dataclass
class ToxicityModel:
    """Learned terms, trees and calibration; ``share`` is the score where trees could not be grown."""

    terms: Terms
    share: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None

    def score(self, docs: DataFrame, text: str = "text", keep_text: bool = True, name: str = "tox_score") -> DataFrame:
        """``docs`` with ``name``, 0 to 1; a column of that name is replaced, all others stay, whatever they are called."""
        if self.trees is None:
            out = docs if keep_text else docs.drop(text)
            return out.withColumn(name, F.lit(float(self.share)))
        features, vector, raw, probability, class_, margin, calibrated = free_names(
            docs, "features", "vector", "raw", "probability", "class", "margin", "calibrated"
        )
        made = with_features(docs, self.terms, text, keep_text, features)
        kept = [c for c in made.columns if c not in (features, name)]
        trees = self.trees.copy().setFeaturesCol(vector).setRawPredictionCol(raw)
        trees = trees.setProbabilityCol(probability).setPredictionCol(class_)
        scored = trees.transform(made.withColumn(vector, array_to_vector(F.col(f"`{features}`"))))
        scored = scored.withColumn(margin, vector_to_array(F.col(f"`{raw}`"))[1])
        scored = self.calibration.copy().setFeaturesCol(margin).setPredictionCol(calibrated).transform(scored)
        score = F.least(F.greatest(F.col(f"`{calibrated}`"), F.lit(0.0)), F.lit(1.0))
        return scored.select(*[F.col(f"`{c}`") for c in kept], score.alias(name))


def fit(labelled: DataFrame, sample: int = SAMPLE, seed: int = 5) -> ToxicityModel:
    """Fits on (doc_id, text, toxic); about ``sample`` rows at most should come in."""
    work = Workspace(labelled.sparkSession, "toxic-fit")
    fold, later = (F.pmod(F.xxhash64("doc_id", F.lit(seed + k)), F.lit(n)) for k, n in ((0, FOLDS), (1, 4)))
    rows = work.write(
        labelled.select(
            "text", F.col("toxic").cast("int").alias("toxic"), fold.cast("int").alias("fold"), (later == 0).alias("later")
        ),
        "rows",
    )
    # Written first, so that no task holds both the sorted texts and the counted terms.
    *others, terms = learn_terms(work.write(without_copies(rows), "firsts"))
    parts = [with_features(rows.filter(F.col("fold") == i), t, keep_text=False) for i, t in enumerate(others)]
    made = work.write(reduce(DataFrame.unionByName, parts), "features").withColumn(
        "_tox_vector", array_to_vector("tox_features")
    )
    grow, check = made.filter("NOT later"), made.filter("later")
    classes = {(r["later"], r["toxic"]): r["count"] for r in made.groupBy("later", "toxic").count().collect()}
    n = sum(classes.values())
    share = sum(v for (_, y), v in classes.items() if y) / n if n else 0.0
    if any(not classes.get((later, y)) for later in (False, True) for y in (0, 1)):
        return ToxicityModel(terms, share)
    trees = GBTClassifier(
        featuresCol="_tox_vector", labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.2, seed=seed
    ).fit(grow)
    trees.setRawPredictionCol("_tox_raw").setProbabilityCol("_tox_probability").setPredictionCol("_tox_class")
    margin = trees.transform(check).select(vector_to_array("_tox_raw")[1].alias("_tox_margin"), F.col("toxic").cast("double").alias("toxic"))
    calibration = IsotonicRegression(
        featuresCol="_tox_margin", labelCol="toxic", predictionCol="_tox_calibrated"
    ).fit(margin)
    work.drop()
    return ToxicityModel(terms, share, trees, calibration)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id is not one of them, and has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of about ``sample`` labelled rows at most, none of them held out.

    The picked ids are broadcast; ``sample`` bounds them, so the texts are not shuffled.
    """
    own = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = own.count()
    if n > sample:
        own = own.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")


def score_documents(
    docs: DataFrame,
    labelled_docs: DataFrame,
    labels: DataFrame,
    keep_text: bool = True,
    sample: int = SAMPLE,
    name: str = "tox_score",
) -> DataFrame:
    """``docs`` with ``name``; the model is learned from ``labelled_docs`` and ``labels``."""
    return fit(training_rows(labelled_docs, labels, sample), sample).score(docs, keep_text=keep_text, name=name)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, docs, read_table(spark, sf_dir, "labels"), keep_text=False)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
