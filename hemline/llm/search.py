"""Ranked lexical search, reversed: the items' inverted index is held, the documents stream through it.

The items are a stated query set. Their distinct terms make an inverted index, cut by whole items into blocks of about
``MOST_POSTINGS`` postings (and one item's at most beyond that), so that what a task and the driver hold has a bound that
does not follow the number of items. For each block

1. every document is read once and becomes the counts of the block's terms in it, written to the shared folder;
2. document frequencies of these terms and the corpus sums come from that table;
3. it is streamed through the index: a document's terms give whole-number contributions, which are added per item, and
   each task keeps a heap of the ``k`` best documents of each item;
4. the tasks' heaps, ``k`` rows per item and task at most, are merged by a ranking that drops rows before its exchange.

The score is that of the ranking's contract: weights in doubles rounded down once per term, all else in 64-bit
whole numbers, so results don't depend on the order of documents.

Null texts have no terms; documents without terms count in no statistic and are never found; items without terms, and
empty tables, give no rows. Every row of documents is one document, so repeated rows rank one after the other; equal
scores go by ascending id, a null id comes last. Rows of items with one id (null too) are one item with the terms of all.
Other columns of either table are not read, whatever their names. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hemline.llm.common import Index, Workspace, read_table, text_pieces
from hemline.llm.terms import ALPHANUMERIC, term_counts

MOST_POSTINGS = 500_000
#: Scores (documents times items) that a task works on at once.
CELLS = 2_000_000
TOP = 10
LAST = (1 << 63) - 1


@dataclass(frozen=True)
class InvertedIndex:
    """Items of one block and, for each distinct term, the items that hold it."""

    items: pa.Array
    terms: Index
    starts: np.ndarray
    holders: np.ndarray


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all their terms, and the weight of each term of the index."""

    documents: int
    tokens: int
    weights: np.ndarray


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term) of the distinct terms of each item, the term as a hash."""
    kind = items.schema[item_id].dataType

    def run(batches):
        for rows, data, offsets in text_pieces(batches, text):
            found = term_counts(data, offsets, ALPHANUMERIC)
            owner = rows.column(rows.schema.get_field_index(item_id)).take(pa.array(found.text))
            hashes = pa.array(found.hashes[found.term].view(np.int64))
            yield pa.RecordBatch.from_arrays([owner, hashes], ["item", "term"])

    schema = T.StructType([T.StructField("item", kind), T.StructField("term", T.LongType())])
    return items.select(item_id, text).mapInArrow(run, schema).distinct()


def build_index(postings: DataFrame) -> InvertedIndex:
    """The index of a block's (item, term) rows, which are collected: the caller bounds their number."""
    got = postings.toArrow()
    items = got.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
    terms, term = np.unique(got.column("term").to_numpy(), return_inverse=True)
    order = np.argsort(term, kind="stable")
    starts = np.searchsorted(term[order], np.arange(len(terms) + 1))
    return InvertedIndex(items.dictionary, Index(terms), starts, items.indices.to_numpy()[order])


def counts_of_terms(docs: DataFrame, index, doc_id: str, text: str) -> DataFrame:
    """(doc, n, terms, counts): all terms of each document, and its counts of the index's terms by their number."""

    def run(batches):
        known = index.value.terms
        for rows, data, offsets in text_pieces(batches, text):
            found = term_counts(data, offsets, ALPHANUMERIC)
            number = known.find(found.hashes)[found.term]
            hit = number >= 0
            ends = np.searchsorted(found.text[hit], np.arange(len(offsets))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[hit])) for x in (number, found.count)]
            own = rows.column(rows.schema.get_field_index(doc_id)).cast(pa.int64())
            made = pa.RecordBatch.from_arrays([own, pa.array(found.total), *lists], ["doc", "n", "terms", "counts"])
            yield made.filter(pa.array(found.total > 0))

    schema = "doc long, n long, terms array<long>, counts array<long>"
    return docs.select(doc_id, text).mapInArrow(run, schema)


def corpus_of(counted: DataFrame, n_terms: int) -> Corpus:
    """Sums over all documents and the weights, one number per term of the block's index."""
    sums = counted.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    df = np.zeros(n_terms, np.int64)
    df[held.column("term").to_numpy()] = held.column("df").to_numpy()
    n = sums["documents"]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()]
    return Corpus(n, sums["tokens"], np.array(weights, np.int64))


class Heaps:
    """The ``k`` best (score, document) of each item; of equal scores the smaller document is better."""

    def __init__(self, n_items: int, k: int):
        self.k, self.held = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def take(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """A table of scores, documents by items. Rows that can't enter are left out before the heaps are touched."""
        least = self.least
        if len(docs) > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=0)[-self.k])
        at, item = np.nonzero(scores >= least)
        for i, x in zip(item.tolist(), zip(scores[at, item].tolist(), (-docs[at]).tolist(), strict=True), strict=True):
            heap = self.held[i]
            if len(heap) < self.k:
                heapq.heappush(heap, x)
            elif x > heap[0]:
                heapq.heapreplace(heap, x)
        for i in np.unique(item).tolist():
            if len(self.held[i]) == self.k:
                self.least[i] = self.held[i][0][0]

    def rows(self) -> tuple[list[int], list[int], list[int]]:
        flat = [(i, -doc, score) for i, heap in enumerate(self.held) for score, doc in heap]
        return tuple(map(list, zip(*flat, strict=True))) if flat else ([], [], [])


def contributions(n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, corpus: Corpus) -> np.ndarray:
    """What each (document, term) adds to the scores of the term's items; all in whole numbers."""
    m = 10 + (90 * n * corpus.documents) // corpus.tokens
    return corpus.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))


def _best_schema(kind: T.DataType) -> T.StructType:
    return T.StructType().add("item", kind).add("doc", "long").add("score", "long")


def _best(counted: DataFrame, index, corpus: Corpus, kind: T.DataType, k: int) -> DataFrame:
    """(item, doc, score): the heaps of each task."""

    def run(batches):
        held, heaps = index.value, None
        width = len(held.items)
        lengths = np.diff(held.starts)
        for batch in batches:
            heaps = heaps or Heaps(width, k)
            n, lists = batch.column(1).to_numpy(), batch.column(2)
            ids = batch.column(0).fill_null(LAST).to_numpy()
            ends = lists.offsets.to_numpy()
            terms, tfs = (batch.column(i).values.to_numpy() for i in (2, 3))
            step = max(1, CELLS // width)
            for low in range(0, len(ids), step):
                high = min(low + step, len(ids))
                term, tf = (x[ends[low] : ends[high]] for x in (terms, tfs))
                doc = np.repeat(np.arange(high - low), np.diff(ends[low : high + 1]))
                value = contributions(n[low:high], doc, term, tf, corpus)
                scores = np.zeros((high - low) * width, np.int64)
                # The postings of so many terms at once that they stay bounded too.
                spread, at = np.cumsum(lengths[term]), 0
                for cut in np.searchsorted(spread, np.arange(CELLS, spread[-1:].sum() + CELLS, CELLS), "right").tolist():
                    part = slice(at, max(cut, at + 1))
                    at = part.stop
                    each = lengths[term[part]]
                    first = np.repeat(held.starts[term[part]] - np.cumsum(each) + each, each)
                    item = held.holders[first + np.arange(len(first))]
                    np.add.at(scores, np.repeat(doc[part], each) * width + item, np.repeat(value[part], each))
                heaps.take(scores.reshape(-1, width), ids[low:high])
        if heaps:
            item, doc, score = heaps.rows()
            ids = pa.array([None if d == LAST else d for d in doc], pa.int64())
            made = [held.items.take(pa.array(item, pa.int64())).cast(arrow), ids, pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, ["item", "doc", "score"])

    arrow = to_arrow_type(kind)
    return counted.mapInArrow(run, _best_schema(kind))


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    most_postings: int = MOST_POSTINGS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for each item, best first.

    ``doc_id`` is a whole number. Documents are read once per block of the index.
    """
    spark = docs.sparkSession
    work, kind = Workspace(spark, "search"), items.schema[item_id].dataType
    postings = work.write(item_terms(items, item_id, text), "postings")
    n_blocks = -(-postings.count() // most_postings)
    found = []
    for b in range(n_blocks):
        own = postings.filter(F.pmod(F.xxhash64("item", F.lit(9)), F.lit(n_blocks)) == b)
        block = build_index(own)
        if not len(block.items):
            continue
        index = spark.sparkContext.broadcast(block)
        counted = work.write(counts_of_terms(docs, index, doc_id, text), f"counts-{b}")
        corpus = corpus_of(counted, len(block.starts) - 1)
        if corpus.documents:
            found.append(work.write(_best(counted, index, corpus, kind, k), f"best-{b}"))
        work.drop(f"counts-{b}")
        index.unpersist()
    best = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _best_schema(kind))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
