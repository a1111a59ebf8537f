"""Source divergence audit: term counts of groups as hash-consed segment trees, compared by memoized traversal.

Each language keeps the terms of at least ``least_docs`` of its documents. The counts of one group (language and source)
over the kept terms are the leaves of a segment tree. Trees are hash-consed level by level: equal subtrees are one node,
within a group and between groups, so the long tails of rare and absent terms shrink to a few nodes. Two groups are
compared by going down both trees at once; a pair of nodes that comes up again, anywhere, is priced once.

1. Tasks count the terms of their texts per group in pieces, Spark sums them.
2. Kept terms are dealt by hash into chunks of about ``CHUNK``, the sources of a language into blocks of about ``BLOCK``.
   A task has one chunk and two blocks, so its size follows neither the vocabulary nor the number of sources nor the
   share of one group; terms of a chunk are ordered by their count in the language, which puts equal counts together.
3. A task builds the trees of its groups, prices all pairs of them over the chunk, and the terms of its groups against
   the language's own tree. Spark sums the pairs over the chunks and ranks.

All numbers are whole; probabilities are scaled to 10^9. Products that pass 64 bits are divided in two steps.

Null text, language and source are empty. A group without terms has a tree of zeros and is compared like any other; a language
without kept terms gives its pairs the value 0. Every row is one document, repeated rows count each. An empty table
gives no rows, a language with one source no pairs. Columns other than text, language and source are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hemline.llm.common import Workspace, read_table, text_pieces
from hemline.llm.terms import LETTERS, term_counts

LEAST_DOCS = 10
TOP_TERMS = 10
CHUNK = 8_192
BLOCK = 64
SCALE = 1_000_000_000
#: SCALE as a product, for divisions in two steps: counts up to 2^63 / 32,000, totals up to 2^63 / 31,250.
STEPS = (32_000, 31_250)
#: Marks a leaf beyond the chunk's terms, which costs nothing.
NO_TERM = -1


def group_terms(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs) of every term of every group."""
    own = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]

    def run(batches):
        for rows, data, offsets in text_pieces(batches, "text"):
            names = [rows.column(i).dictionary_encode() for i in (0, 1)]
            codes = [x.indices.to_numpy().astype(np.int64) for x in names]
            n_sources = len(names[1].dictionary)
            found = term_counts(data, offsets, LETTERS)
            n_terms = max(len(found.hashes), 1)
            group = (codes[0] * n_sources + codes[1])[found.text]
            keys, back, docs_of = np.unique(group * n_terms + found.term, return_inverse=True, return_counts=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, back, found.count)
            group, term = np.divmod(keys, n_terms)
            raw = found.data.tobytes()
            spelled = pa.array([raw[a:b].decode() for a, b in zip(found.starts.tolist(), found.ends.tolist(), strict=True)], pa.string())
            made = [
                names[0].dictionary.take(pa.array(group // n_sources)),
                names[1].dictionary.take(pa.array(group % n_sources)),
                spelled.take(pa.array(term)),
                pa.array(total),
                pa.array(docs_of),
            ]
            yield pa.RecordBatch.from_arrays(made, ["lang", "source", "term", "n", "docs"])

    counted = docs.select(*own, F.col(text).alias("text")).mapInArrow(
        run, "lang string, source string, term string, n long, docs long"
    )
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


@dataclass
class Forest:
    """Hash-consed segment trees: per level the distinct nodes' children, at the bottom the distinct counts."""

    counts: np.ndarray
    levels: list[np.ndarray]
    roots: np.ndarray

    @classmethod
    def grown(cls, counts: np.ndarray) -> Forest:
        """Trees of the rows of ``counts``, whose number of columns is a power of two."""
        distinct, nodes = np.unique(counts, return_inverse=True)
        nodes, levels, below = nodes.reshape(counts.shape), [], len(distinct)
        while nodes.shape[1] > 1:
            pairs = nodes[:, 0::2] * below + nodes[:, 1::2]
            made, nodes = np.unique(pairs, return_inverse=True)
            nodes = nodes.reshape(pairs.shape)
            levels.append(np.stack(np.divmod(made, below), axis=1))
            below = len(made)
        return cls(distinct, levels, nodes[:, 0])

    def compared(self, a: int, b: int, price) -> int:
        """The price of two trees: down both at once, each distinct pair of nodes once, and the sums back up."""
        pairs, backs = np.array([[self.roots[a], self.roots[b]]]), []
        for children in reversed(self.levels):
            width = int(children.max()) + 1
            left, right = children[pairs[:, 0]], children[pairs[:, 1]]
            keys, back = np.unique((left * width + right).ravel(), return_inverse=True)
            pairs = np.stack(np.divmod(keys, width), axis=1)
            backs.append(back.reshape(-1, 2))
        known = (self.counts[pairs] != NO_TERM).all(axis=1)
        value = np.where(known, price(*np.maximum(self.counts[pairs], 0).T), 0)
        for back in reversed(backs):
            value = value[back].sum(axis=1)
        return int(value[0])


def share(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), exactly; ``total`` is N + 2 V."""
    whole, rest = np.divmod((counts + 2) * STEPS[0], max(total, 1))
    return 1 + whole * STEPS[1] + rest * STEPS[1] // max(total, 1)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _audited(table: pa.Table, top: int) -> pa.Table:
    """(lang, source, part, item, value) of one chunk and two blocks of sources.

    ``table`` has a row per group of the blocks (term null) and per count of a group above zero.
    """
    terms = table.column("term").combine_chunks().dictionary_encode()
    heads, rows = table.filter(terms.is_null()), table.filter(terms.is_valid())
    lang, size = heads.column("lang")[0], heads.column("size")[0].as_py()
    sources, totals, sides = (heads.column(c).to_pylist() for c in ("source", "total", "side"))
    place = {s: i for i, s in enumerate(sources)}
    spelled, n_lang = terms.dictionary.to_pylist(), np.zeros(len(terms.dictionary), np.int64)
    term = terms.drop_null().indices.to_numpy()
    n_lang[term] = rows.column("n_lang").to_numpy()
    order = np.array(sorted(range(len(spelled)), key=lambda i: (-n_lang[i], spelled[i].encode())), np.int64)
    at = np.empty(len(order), np.int64)
    at[order] = np.arange(len(order))
    width = 1 << max(size - 1, 0).bit_length()
    counts = np.zeros((len(sources) + 1, width), np.int64)
    counts[:, size:] = NO_TERM
    group = np.array([place[s] for s in rows.column("source").to_pylist()], np.int64)
    counts[group, at[term]] = rows.column("n").to_numpy()
    counts[-1, : len(order)] = n_lang[order]
    forest = Forest.grown(counts)
    made = []

    def add(source, part, item, value):
        made.append((source, part, item, value))

    same_block = heads.column("block_a")[0] == heads.column("block_b")[0]
    for a in range(len(sources)):
        for b in range(a + 1, len(sources)):
            if same_block or sides[a] != sides[b]:
                value = forest.compared(a, b, lambda x, y, a=a, b=b: divergence(share(x, totals[a]), share(y, totals[b])))
                add(sources[a], "pair", sources[b], value)
                add(sources[b], "pair", sources[a], value)
    if same_block:
        total_lang = heads.column("total_lang")[0].as_py()
        for g, source in enumerate(sources):
            own = np.flatnonzero(counts[g, :size] > 0)
            leaves, back = np.unique(counts[[g, -1]][:, own], axis=1, return_inverse=True)
            p, q = share(leaves[0], totals[g]), share(leaves[1], total_lang)
            value = np.where(p > q, divergence(p, q), -1)[back.ravel()]
            # Places go by count and then term, so equal values are sorted again by term.
            best = [i for i in range(len(own)) if value[i] >= 0]
            best.sort(key=lambda i: (-value[i], spelled[order[own[i]]].encode()))
            for i in best[:top]:
                add(source, "term", spelled[order[own[i]]], int(value[i]))
    columns = list(zip(*made, strict=True)) if made else [[], [], [], []]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
    arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
    langs = pa.array([lang.as_py()] * len(made), pa.string())
    return pa.table([langs, *arrays], names=["lang", "source", "part", "item", "value"])


def audit_sources(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from its others, and by which terms.

    Part ``pair`` has every other source of the language; part ``term`` the ``top`` terms that the source has more often than
    the language. Ranks run from 1 per group and part, highest value first, equal ones by item in byte order.
    """
    work = Workspace(docs.sparkSession, "divergence")
    counts = work.write(group_terms(docs, text, lang, source), "counts")
    kept = work.write(
        counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs).drop("docs"),
        "kept",
    )
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    groups = work.write(docs.select(*empty).groupBy("lang", "source").count(), "groups")

    def dealt(of: str, n: Column, size: int) -> Column:
        return F.pmod(F.xxhash64(of), F.greatest(F.lit(1), F.ceil(n / size))).cast("int")

    langs = work.write(
        groups.groupBy("lang")
        .agg(F.count("*").alias("n_sources"))
        .join(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("n_all")), "lang", "left")
        .na.fill(0, ["v", "n_all"])
        .select("lang", "n_sources", "v", (F.col("n_all") + 2 * F.col("v")).alias("total_lang")),
        "langs",
    )
    placed = work.write(kept.join(langs, "lang").withColumn("chunk", dealt("term", F.col("v"), chunk)).select("lang", "term", "n_lang", "chunk"), "placed")
    own = work.write(counts.join(placed, ["lang", "term"]).select("lang", "chunk", "source", "term", "n", "n_lang"), "own")
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    members = work.write(
        groups.drop("count")
        .join(sums, ["lang", "source"], "left")
        .join(langs, "lang")
        .withColumn("side", dealt("source", F.col("n_sources"), block))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("n_sources") / block)).cast("int"))
        .select("lang", "source", "side", "blocks", "v", "total_lang", (F.coalesce("n_group", F.lit(0)) + 2 * F.col("v")).alias("total")),
        "members",
    )
    # Every chunk of a language, with the number of its terms; chunk 0 of a language without terms is empty.
    every = langs.select("lang", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("v") / chunk)).cast("int") - 1)).alias("chunk"))
    sizes = work.write(
        every.join(placed.groupBy("lang", "chunk").agg(F.count("*").alias("size")), ["lang", "chunk"], "left").na.fill(0, ["size"]), "sizes"
    )
    heads = members.join(sizes, "lang").select(
        "lang", "chunk", "source", "side", "blocks", "total", "total_lang", "size", F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("n_lang"),
    )
    body = own.join(members.select("lang", "source", "side", "blocks"), ["lang", "source"]).select(
        "lang", "chunk", "source", "side", "blocks", *[F.lit(0).cast("long").alias(c) for c in ("total", "total_lang", "size")],
        "term", "n", "n_lang",
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = (
        heads.unionByName(body)
        .withColumn("other", other)
        .withColumn("block_a", F.least("side", "other"))
        .withColumn("block_b", F.greatest("side", "other"))
        .drop("other", "blocks")
    )
    priced = tasks.groupBy("lang", "chunk", "block_a", "block_b").applyInArrow(
        lambda table: _audited(table, top), "lang string, source string, part string, item string, value long"
    )
    found = work.write(priced, "found")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    terms = found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(read_table(spark, sf_dir, "documents"))
