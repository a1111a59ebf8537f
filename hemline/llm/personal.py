"""Personal data: base expressions as seeds, and contexts bootstrapped from them that find identifiers of other forms.

Base entities (mail addresses, network addresses, card and phone numbers) are found by expressions and their checks. They
are the seeds of a pattern-instance graph:

- an *instance* is the spelling of a base entity, or of a candidate: a run of letters, digits and ``@._+/#-`` that holds an
  ``@`` or at least ``LEAST_DIGITS`` digits and touches no base entity;
- a *pattern* is the last word, or the last two words, before an instance, lower-cased, with at most ``GAP`` other bytes
  after each word and no line feed between.

Spark counts the edges over all texts. A pattern's confidence in a kind is the share of all its occurrences in the corpus,
before ordinary words too, that precede a base entity or an accepted candidate of the kind; occurrences before candidates
that are not accepted (yet) weigh half. It counts only with ``SUPPORT`` different instances, so copies of one passage can't make a
pattern. A candidate is accepted when the chance that not all of
its confident patterns err reaches ``ACCEPT``; accepted candidates are instances for the next round, whose patterns may discover
others. After ``ROUNDS`` rounds, or earlier if a round accepts nothing new, all mentions of accepted candidates become spans of the kinds
``like_email``, ``like_ip``, ``like_card`` and ``like_phone``.

Base spans are never changed. Null texts count as empty; empty texts and tables give no spans. Every row is scanned on its own,
so repeated rows repeat their result, though all of them count as occurrences. Columns of the input with the names of results
are replaced, all others carried along. Words and spellings are compared by 64-bit hashes. Expressions take time in
proportion to the text, whatever its runs of letters or digits are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemline.llm.common import (
    Workspace, append_columns, class_runs, free_names, mixed, read_table, run_hashes, text_pieces, texts_of,
)
from hemline.llm.seeds import bit_table, in_table
from hemline.llm.terms import LETTERS, LOWER

# Kinds in the order of the spans, and the parts of their expressions.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = rb"A-Za-z0-9._%+-"
DOMAIN = rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
ADDRESS = rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = rb"[0-9]+(?:[\x20-][0-9]+)*+"
PHONE = rb"\+[0-9][\x20().0-9-]+[0-9]"

LEAST_DIGITS = 4
GAP = 3
MOST_WORD = 40
SUPPORT = 3
CONFIDENT = 0.5
ACCEPT = 0.5
#: Occurrences that every pattern has more, before no identifier.
PRIOR = 1.0
ROUNDS = 4

_LOCAL_BYTES = np.isin(np.arange(256), [b for b in range(256) if re.match(rb"[" + LOCAL + rb"]", bytes([b]))])
_TOKEN_BYTES = np.isin(np.arange(256), [b for b in range(128) if chr(b).isalnum() or chr(b) in "@._+/#-"])
_DOMAIN, _ADDRESS, _CARD, _PHONE = map(re.compile, (DOMAIN, ADDRESS, CARD, PHONE))
_LUHN = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def _emails(text: bytes) -> list[tuple[int, int]]:
    """Each ``@`` in turn: its local part is the run before it, as far as no earlier match has taken it."""
    found, free, at = [], 0, text.find(b"@")
    while at >= 0:
        low = at
        while low > free and _LOCAL_BYTES[text[low - 1]]:
            low -= 1
        match = _DOMAIN.match(text, at + 1) if low < at else None
        # Beyond an ``@`` that has no match no local part can reach back, as ``@`` is none of its characters.
        free = match.end() if match else at + 1
        if match:
            found.append((low, free))
        at = text.find(b"@", max(at + 1, free))
    return found


def _small(part: bytes) -> bool:
    digits = part.lstrip(b"0")
    return len(digits) < 4 and int(digits or b"0") <= 255


def luhn(digits: bytes) -> bool:
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(odd) - 48 * len(odd) + sum(_LUHN[d - 48] for d in even)) % 10 == 0


def _digits(raw: bytes) -> bytes:
    return raw.translate(None, delete=b" -().+")


def base_entities(text: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) in bytes, by kind and start; what an expression matches and its check refuses is not tried again."""
    found = [(0, a, b) for a, b in _emails(text)]
    found += [(1, m.start(), m.end()) for m in _ADDRESS.finditer(text) if all(map(_small, m[0].split(b".")))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def _candidates(data: np.ndarray, offsets: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the candidates of a piece; ``taken`` marks the bytes of base entities."""
    starts, ends, _ = class_runs(data, offsets, _TOKEN_BYTES)

    def inside(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[ends] - total[starts]

    digits = (data >= 0x30) & (data <= 0x39)
    pick = ((inside(digits) >= LEAST_DIGITS) | (inside(data == 0x40) > 0)) & (inside(taken) == 0)
    starts, ends = starts[pick], ends[pick]
    # Marks at the ends belong to the sentence and not to the identifier.
    solid = np.flatnonzero(_TOKEN_BYTES[data] & ~np.isin(data, list(b"._+/-")))
    low = solid[np.minimum(np.searchsorted(solid, starts), max(len(solid) - 1, 0))] if len(solid) else starts
    high = solid[np.searchsorted(solid, ends) - 1] + 1 if len(solid) else ends
    whole = (low >= starts) & (high <= ends) & (low < high)
    return low[whole], high[whole]


class Words:
    """Words of a piece and the hashes of the patterns that end with each: of one word, and of two."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        lower = LOWER[data]
        self.starts, self.ends, first = class_runs(data, offsets, LETTERS)
        n = len(self.starts)
        feeds = np.concatenate([[0], np.cumsum(data == 0x0A)])
        self._feeds = feeds
        own = run_hashes(lower, self.starts, self.ends)
        short = self.ends - self.starts <= MOST_WORD
        near = np.zeros(n, bool)
        if n > 1:
            near[1:] = (self.starts[1:] - self.ends[:-1] <= GAP) & (feeds[self.starts[1:]] == feeds[self.ends[:-1]]) & short[:-1]
        lead = first[:-1][np.diff(first) > 0]
        near[lead] = False
        self.one, self.two = mixed(own), np.zeros(n, np.uint64)
        if n > 1:
            before = np.concatenate([own[:1], own[:-1]])
            self.two = mixed(own ^ mixed(before + np.uint64(1)) + np.uint64(2))
        self.has_one, self.has_two = short, near & short
        self._bounds = first

    def before(self, starts: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The word before each place, and whether it is near enough to be its context."""
        at = np.searchsorted(self.ends, starts, "right") - 1
        near = at >= self._bounds[texts]
        at = np.maximum(at, 0)
        if len(self.ends):
            near &= (starts - self.ends[at] <= GAP) & (self._feeds[starts] == self._feeds[self.ends[at]])
        return at, near & (len(self.ends) > 0)


def _points(data: np.ndarray, places: np.ndarray, offsets: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Code points before each byte place in its own text."""
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return leads[places] - leads[offsets[texts]]


def _scan(data: np.ndarray, offsets: np.ndarray) -> dict[str, object]:
    """Base results and the mentions of each text, as arrays per mention."""
    found = [base_entities(t) for t in texts_of(data, offsets)]
    n_texts = len(found)
    flat = np.array([(i, k, a, b) for i, own in enumerate(found) for k, a, b in own], np.int64).reshape(-1, 4)
    text, kind, low, high = flat.T
    low, high = low + offsets[text], high + offsets[text]
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, low, 1)
    np.add.at(edge, high, -1)
    c_low, c_high = _candidates(data, offsets, np.cumsum(edge)[:-1] > 0)
    c_text = np.searchsorted(offsets, c_low, "right") - 1
    text, kind = np.concatenate([text, c_text]), np.concatenate([kind, np.full(len(c_low), -1)])
    low, high = np.concatenate([low, c_low]), np.concatenate([high, c_high])
    order = np.lexsort((low, kind, text))
    text, kind, low, high = text[order], kind[order], low[order], high[order]
    lower, spelled = LOWER[data], np.zeros(len(low), np.uint64)
    for k in range(-1, len(KINDS)):
        own = kind == k
        spelled[own] = run_hashes(lower, low[own], high[own])
    words = Words(data, offsets)
    at, near = words.before(low, text)
    one, two = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    has_one, has_two = np.zeros(len(at), bool), np.zeros(len(at), bool)
    if len(words.ends):
        one, two = words.one[at].view(np.int64), words.two[at].view(np.int64)
        has_one, has_two = near & words.has_one[at], near & words.has_two[at]
    start, end = _points(data, low, offsets, text), _points(data, high, offsets, text)
    base = kind >= 0
    counts = [np.bincount(text[kind == k], minlength=n_texts) for k in range(len(KINDS))]
    spans = [[] for _ in range(n_texts)]
    for i, k, a, b in zip(*(x[base].tolist() for x in (text, kind, start, end)), strict=True):
        spans[i].append(f"{KINDS[k]}:{a}:{b}")
    ends = pa.array(np.searchsorted(text, np.arange(n_texts + 1)).astype(np.int32))
    parts = {
        "kind": pa.array(kind.astype(np.int32)),
        "start": pa.array(start),
        "end": pa.array(end),
        "instance": pa.array(spelled.view(np.int64)),
        "one": pa.array(one, mask=~has_one),
        "two": pa.array(two, mask=~has_two),
    }
    mentions = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(list(parts.values()), list(parts)))
    return {
        **{f"n_{k}": n for k, n in zip(KINDS, counts, strict=True)},
        "base_spans": [",".join(x) for x in spans],
        "mentions": mentions,
    }


_MENTION = "array<struct<kind: int, start: long, end: long, instance: long, one: long, two: long>>"


def pattern_totals(docs: DataFrame, wanted: DataFrame, text: str, work: Workspace) -> DataFrame:
    """(pattern, total): occurrences over all texts of the patterns in ``wanted``, whatever follows them.

    A bit table of the patterns leaves out most others before the exchange; what it lets through is counted and not joined.
    """
    n = wanted.count()
    table = docs.sparkSession.sparkContext.broadcast(bit_table(wanted.withColumnRenamed("pattern", "key"), n))

    def run(batches):
        for _, data, offsets in text_pieces(batches, text):
            words = Words(data, offsets)
            keys = np.concatenate([words.one[words.has_one], words.two[words.has_two]])
            keys, count = np.unique(keys[in_table(table.value, keys)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(count)], ["pattern", "n"])

    counted = docs.select(text).mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    return work.write(work.write(counted, "counted").join(wanted, "pattern", "left_semi"), "totals")


def bootstrap(edges: DataFrame, totals: DataFrame, work: Workspace, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Accepted candidates (instance, kind, score) and confident patterns (pattern, kind, confidence, support).

    ``edges`` has (pattern, instance, kind, n), kind -1 for candidates; ``totals`` (pattern, total).
    """
    open_edges = edges.filter("kind < 0").select("pattern", "instance", "n")
    seed_edges = edges.filter("kind >= 0").select("pattern", "n", "kind", F.lit(0).cast("long").alias("taken"))
    undecided = work.write(open_edges.groupBy("pattern").agg(F.sum("n").alias("undecided")), "undecided")
    totals = work.write(totals.join(undecided, "pattern", "left").na.fill(0, ["undecided"]), "totals-and-undecided")
    accepted, patterns, before = edges.select("instance", "kind", F.lit(1.0).alias("score")).filter("false"), None, 0
    for i in range(1, rounds + 1):
        taken = open_edges.join(accepted, "instance").select("pattern", "n", "kind", F.col("n").alias("taken"))
        sums = (
            (seed_edges.unionByName(taken) if before else seed_edges)
            .groupBy("pattern", "kind")
            .agg(F.sum("n").alias("hits"), F.sum("taken").alias("taken"), F.count("*").alias("support"))
        )
        confidence = F.col("hits") / (F.col("total") - (F.col("undecided") - F.col("taken")) / 2 + F.lit(PRIOR))
        patterns = work.write(
            work.write(sums.filter(F.col("support") >= SUPPORT), f"sums-{i}")
            .join(totals, "pattern")
            .select("pattern", "kind", F.least(confidence, F.lit(1.0)).alias("confidence"), "support")
            .filter(F.col("confidence") >= CONFIDENT),
            f"patterns-{i}",
        )
        err = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        scored = open_edges.join(patterns, "pattern").groupBy("instance", "kind").agg((1 - err).alias("score"))
        # Of kinds with equal scores the first as listed.
        best = scored.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("order"))).alias("b"))
        accepted = work.write(
            best.select("instance", (-F.col("b.order")).alias("kind"), F.col("b.score").alias("score")).filter(F.col("score") >= ACCEPT),
            f"accepted-{i}",
        )
        now = accepted.count()
        if now <= before:
            break
        before = now
    return accepted, patterns


def find_personal_data(docs: DataFrame, text: str = "text", keep_text: bool = True, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with the personal data of each whole text.

    Adds ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (long), ``base_spans`` and ``spans`` (kind:start:end in code points, by kind as
    listed and then start, joined by commas) and ``n_found`` (long), the spans beyond the base ones.
    """
    work = Workspace(docs.sparkSession, "personal-data")
    results = [*[f"n_{k}" for k in KINDS], "base_spans", "spans", "n_found"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in results])
    mentions, row, number = free_names(docs, "mentions", "row", "number")
    fields = {f"n_{k}": "long" for k in KINDS} | {"base_spans": "string", mentions: _MENTION}

    def make(data, offsets):
        made = _scan(data, offsets)
        made[mentions] = made.pop("mentions") if mentions != "mentions" else made["mentions"]
        return made

    scanned = append_columns(docs, text, fields, make, keep_text)
    # The number of a row holds from here on, because it is written.
    scanned = work.write(scanned.withColumn(row, F.monotonically_increasing_id()), "scanned")
    flat = scanned.filter(F.size(mentions) > 0).select(F.col(row).alias("row"), F.explode(mentions).alias("m")).select("row", "m.*")
    both = flat.select("instance", "kind", F.explode(F.array("one", "two")).alias("pattern")).filter("pattern IS NOT NULL")
    edges = work.write(both.groupBy("pattern", "instance", "kind").agg(F.count("*").alias("n")), "edges")
    wanted = work.write(
        edges.groupBy("pattern").agg(F.count("*").alias("instances")).filter(F.col("instances") >= SUPPORT).select("pattern"), "wanted"
    )
    totals = pattern_totals(docs, wanted, text, work)
    narrow = work.write(edges.join(wanted, "pattern", "left_semi"), "narrow")
    accepted, _ = bootstrap(narrow, totals, work, rounds)
    hits = flat.filter("kind < 0").join(accepted.select("instance", F.col("kind").alias("found_as")), "instance")
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("found_as", "start", "end"))),
        lambda x: F.concat_ws(":", F.concat(F.lit("like_"), F.element_at(F.array(*map(F.lit, KINDS)), x["found_as"] + 1)), x["start"], x["end"]),
    )
    own = work.write(
        hits.groupBy(F.col("row").alias(row)).agg(F.concat_ws(",", listed).alias("spans"), F.count("*").alias("n_found")), "found"
    )
    kept = [c for c in scanned.columns if c not in (mentions, row)]
    base = scanned.drop(mentions)
    spans = F.concat_ws(",", F.expr("nullif(base_spans, '')"), F.col("spans"))
    with_candidates = F.exists(mentions, lambda m: m["kind"] < 0)
    plain = scanned.filter(~with_candidates).select(*[F.col(f"`{c}`") for c in kept], F.col("base_spans").alias("spans"), F.lit(0).cast("long").alias("n_found"))
    rest = (
        scanned.filter(with_candidates)
        .drop(mentions)
        .join(own, row, "left")
        .select(*[F.col(f"`{c}`") for c in kept], spans.alias("spans"), F.coalesce("n_found", F.lit(0)).alias("n_found"))
    )
    return plain.unionByName(rest)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_personal_data(docs, keep_text=False).selectExpr(
        "doc_id", *[f"n_{k}" for k in KINDS], "sha2(base_spans, 256) AS base_sha256", "spans", "n_found"
    )
