"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut where no merge can cross: before a run of spaces and around line feeds. The distinct segments of
a batch that are not in the worker's cache become one flat numpy array of symbols. Each round looks at the
ranks of all neighbouring pairs, takes the smallest rank per segment, merges its leftmost pairs at the same
time and closes the gaps; segments without a pair leave the arrays. A pair further right of the same rank
waits for the next round if a merge to its left makes a pair that comes first, so the order of merges is the
library's.

Null and empty texts get the begin and end ids and decode to an empty text. The vocabulary file is a
parameter; its bytes (well under a megabyte) are broadcast, so executors need no copy. The cache is bounded by
``CACHE`` segments.
"""

from __future__ import annotations

from hashlib import sha256
from re import compile as pattern

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from hemline.llm.common import append_columns, read_table, texts_of

CACHE = 250_000
NONE = np.int32(2**31 - 1)
_SEGMENT = pattern(r" +[^ \n]*|\n|[^ \n]+")
_loaded: dict[str, Encoder] = {}
SLOTS = 1 << 21


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).view(np.int64)


def _placed(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open-addressing table of (key, value) rows: keys, -1 where free, and values."""
    keys, values = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, np.int64)
    at, left = _slots(pairs[:, 0].copy()), np.arange(len(pairs))
    if 2 * len(pairs) > SLOTS:
        raise ValueError("the vocabulary has too many pairs for the table")
    while len(left):
        free = keys[at[left]] < 0
        take, first = np.unique(at[left[free]], return_index=True)
        rows = left[free][first]
        keys[take], values[take] = pairs[rows, 0], pairs[rows, 1]
        left = np.setdiff1d(left, rows)
        at[left] = (at[left] + 1) & (SLOTS - 1)
    return keys, values


class Encoder:
    """Tables of one vocabulary and the encoder over them."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = library.get_piece_size()
        texts = [library.id_to_piece(i) for i in range(n)]
        special = [library.is_byte(i) or library.is_control(i) or library.is_unknown(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(n):
            if library.is_byte(i):
                self.byte_ids[int(texts[i][3:5], 16)] = i
        self.begin, self.end = library.bos_id(), library.eos_id()
        normal = {t: i for i, t in enumerate(texts) if not special[i]}
        self.raw = [
            bytes([int(t[3:5], 16)]) if library.is_byte(i) else b"" if special[i] else t.replace("▁", " ").encode()
            for i, t in enumerate(texts)
        ]
        if any("▁" in t.lstrip("▁") or "\n" in t[1:] or "\n" in t[:-1] for t in normal):
            raise ValueError("pieces cross spaces or line feeds: texts can't be cut there")
        # Equal scores get equal ranks; the leftmost pair then comes first.
        scores = sorted({library.get_score(i) for i in normal.values()}, reverse=True)
        order = {s: r for r, s in enumerate(scores)}
        self.rank = np.full(n, NONE, np.int32)
        for i in normal.values():
            self.rank[i] = order[library.get_score(i)]
        # Every character of a piece is a symbol, whether or not it is a piece itself.
        letters = sorted({c for t in normal for c in t})
        symbol = dict(normal)
        for c in letters:
            symbol.setdefault(c, n + ord(c))
        self.codes = np.array([ord(c) for c in letters], np.uint32)
        self.code_symbol = np.array([symbol[c] for c in letters], np.int64)
        pairs = sorted(
            (symbol[t[:k]] << 24 | symbol[t[k:]], i)
            for t, i in normal.items()
            for k in range(1, len(t))
            if t[:k] in symbol and t[k:] in symbol
        )
        self.pair_keys, self.pair_made = _placed(np.array(pairs, np.int64))
        self.raw_sizes = np.array([len(r) for r in self.raw])
        self.n = n
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        # A character outside the vocabulary merges with nothing: beyond every symbol of the pair table.
        return np.where(self.codes[at] == codes, self.code_symbol[at], (1 << 23) + codes.astype(np.int64))

    def made(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of neighbours joined; rank NONE if they make no piece."""
        keys = left << 24 | right
        at = _slots(keys)
        found = self.pair_keys[at]
        piece = np.where(found == keys, self.pair_made[at], -1)
        more = np.flatnonzero((found != keys) & (found >= 0))
        while len(more):
            at[more] = (at[more] + 1) & (SLOTS - 1)
            found = self.pair_keys[at[more]]
            hit = found == keys[more]
            piece[more[hit]] = self.pair_made[at[more[hit]]]
            more = more[~hit & (found >= 0)]
        return piece, np.where(piece >= 0, self.rank[piece], NONE)

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all segments one after another, and the position of the first character of each."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
        place, sym = np.arange(len(codes)), self.symbols(codes)
        piece, rank = self.beside(sym, owner)
        done_place, done_sym = [], []
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.concatenate([first, [len(sym)]]))
            best = np.minimum.reduceat(rank, first)
            spread = np.repeat(best, sizes)
            over = spread == NONE
            if over.any():
                done_place.append(place[over])
                done_sym.append(sym[over])
                keep = ~over
                owner, place, sym, piece, rank, spread = (
                    x[keep] for x in (owner, place, sym, piece, rank, spread)
                )
                if not len(sym):
                    break
            at = self.chosen(owner, sym, piece, rank, spread)
            sym[at] = piece[at]
            gone = np.zeros(len(sym), bool)
            gone[at + 1] = True
            changed = np.zeros(len(sym), bool)
            changed[at] = True
            # The symbol before a merged pair has a new neighbour too; it may itself end a merged pair.
            ahead = at - 1
            ahead = np.where((ahead >= 0) & gone[ahead], ahead - 1, ahead)
            changed[ahead[ahead >= 0]] = True
            owner, place, sym, piece, rank, changed = (
                x[~gone] for x in (owner, place, sym, piece, rank, changed)
            )
            look = np.flatnonzero(changed)
            nxt = np.minimum(look + 1, len(sym) - 1)
            piece[look], fresh = self.made(sym[look], sym[nxt])
            rank[look] = np.where((look + 1 < len(sym)) & (owner[look] == owner[nxt]), fresh, NONE)
        place = np.concatenate([*done_place, np.empty(0, np.int64)]).astype(np.int64)
        sym = np.concatenate([*done_sym, np.empty(0, np.int64)]).astype(np.int64)
        order = np.argsort(place, kind="stable")
        return sym[order], place[order]

    def beside(self, sym: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        piece, rank = np.zeros(len(sym), np.int64), np.full(len(sym), NONE, np.int32)
        if len(sym) > 1:
            piece[:-1], fresh = self.made(sym[:-1], sym[1:])
            rank[:-1] = np.where(owner[:-1] == owner[1:], fresh, NONE)
        return piece, rank

    def chosen(self, owner, sym, piece, rank, best) -> np.ndarray:
        """Positions of the pairs to merge in this round."""
        hit = np.flatnonzero((rank == best) & (rank != NONE))
        run = np.cumsum(np.concatenate([[True], np.diff(hit) != 1])) - 1
        run_start = np.flatnonzero(np.concatenate([[True], np.diff(run) != 0]))
        at = hit[(np.arange(len(hit)) - run_start[run]) % 2 == 0]  # every second of pairs that overlap
        lead = np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])
        if lead.all():
            return at
        made = piece[at]
        before = np.maximum(at - 1, 0)
        left = sym[before].copy()
        joined = np.flatnonzero(np.diff(at) == 2) + 1
        left[joined] = made[joined - 1]
        after = np.minimum(at + 2, len(sym) - 1)
        _, ahead = self.made(left, made)
        _, behind = self.made(made, sym[after])
        ahead = np.where((at > 0) & (owner[before] == owner[at]), ahead, NONE)
        behind = np.where((at + 2 < len(sym)) & (owner[after] == owner[at]), behind, NONE)
        blocks = np.minimum(ahead, behind) <= best[at]
        blocked = np.cumsum(blocks) - blocks  # blocking merges before this one
        start = np.maximum.accumulate(np.where(lead, np.arange(len(at)), 0))
        return at[blocked == blocked[start]]

    def learn(self, segments: list[str]) -> None:
        """Adds segments to the cache: ids as little-endian unsigned 32-bit integers, and their decoded bytes."""
        escaped = [s.replace(" ", "▁") for s in segments]
        sym, place = self.merge(escaped)
        cut = np.searchsorted(place, np.cumsum([0, *map(len, escaped)]))
        if (sym >= self.n).any():
            sym, sizes = self.with_bytes(sym)
            cut = np.concatenate([[0], np.cumsum(sizes)])[cut]
        ids, decoded = sym.astype("<u4").tobytes(), b"".join([self.raw[j] for j in sym.tolist()])
        ends = np.concatenate([[0], np.cumsum(self.raw_sizes[sym])])[cut].tolist()
        for i, s in enumerate(segments):
            self.known[s] = ids[4 * cut[i] : 4 * cut[i + 1]], decoded[ends[i] : ends[i + 1]]

    def with_bytes(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with the bytes of characters that are no piece, and how many ids each symbol became."""
        out: list[list[int]] = []
        for s in sym.tolist():
            code = s - (1 << 23) if s >= 1 << 23 else s - self.n
            out.append([s] if s < self.n else self.byte_ids[list(chr(code).encode())].tolist())
        return np.array([i for own in out for i in own], np.int64), np.array([len(own) for own in out])

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids with begin and end (little-endian 32-bit) and the decoded text (UTF-8) of each text."""
        cut = [_SEGMENT.findall(" " + t.replace("▁", " ")) if t else [] for t in texts]
        used = {s for own in cut for s in own}
        fresh = list(used.difference(self.known))
        if len(self.known) + len(fresh) > CACHE:
            self.known = {s: self.known[s] for s in used.intersection(self.known)}
        if fresh:
            self.learn(fresh)
        known, out = self.known, []
        head, tail = np.array([self.begin], "<u4").tobytes(), np.array([self.end], "<u4").tobytes()
        for own in cut:
            both = [known[s] for s in own]
            decoded = b"".join([x[1] for x in both])
            out.append((head + b"".join([x[0] for x in both]) + tail, decoded[1:]))
        return out


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (array of int, begin and end included) and ``decoded`` per whole text."""

    def make(encoder, data, offsets):
        rows = encoder.encode([t.decode() for t in texts_of(data, offsets)])
        return {
            "n_tokens": [len(ids) // 4 for ids, _ in rows],
            "ids": [np.frombuffer(ids, "<i4") for ids, _ in rows],
            "decoded": [decoded.decode() for _, decoded in rows],
        }

    fields = {"n_tokens": "long", "ids": "array<int>", "decoded": "string"}
    return _append(docs, model_path, text, fields, make, keep_text)


def encode_digests(docs: DataFrame, model_path: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens`` and the SHA-256 of ids and decoded text, for checks without the ids themselves."""

    def make(encoder, data, offsets):
        rows = encoder.encode([t.decode() for t in texts_of(data, offsets)])
        return {
            "n_tokens": [len(ids) // 4 for ids, _ in rows],
            "ids_sha256": [sha256(ids).hexdigest() for ids, _ in rows],
            "decoded_sha256": [sha256(decoded).hexdigest() for _, decoded in rows],
        }

    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return _append(docs, model_path, text, fields, make, keep_text)


def _append(docs, model_path, text, fields, make, keep_text) -> DataFrame:
    with open(model_path, "rb") as file:
        model = file.read()
    key, shared = sha256(model).hexdigest(), docs.sparkSession.sparkContext.broadcast(model)

    def run(data, offsets):
        if key not in _loaded:
            _loaded[key] = Encoder(shared.value)
        return make(_loaded[key], data, offsets)

    return append_columns(docs, text, fields, run, keep_text)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_digests(docs, default_model(), keep_text=False)
