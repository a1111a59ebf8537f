"""Secret scan: keyword automaton, anchored expressions at its hits, embedded checksums.

One Aho-Corasick automaton runs over each whole text and reports where a secret could start: a keyword of a
kind, or, in a copy of the text whose hexadecimal digits are all written as one symbol, the first sixteen
digits of a run. Only there an anchored expression runs. Kinds that carry a checksum are kept only if it
holds. Positions are code points, ends exclusive; matches of a kind don't overlap, the leftmost wins.

Null texts count as empty; empty texts and tables give no spans. Every row is scanned on its own, so repeated
rows repeat their result. Columns of the input other than the text are carried along.
"""

from __future__ import annotations

import re
import zlib

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, SparkSession

from hemline.llm.common import LOWER_ASCII, append_columns, read_table, texts_of

# Kinds in the order of equal starts, their keywords (lower case) and expressions.
KINDS = ["assign", "access", "hex", "token_crc", "package_crc", "private_key", "webhook"]
BASE_KINDS = ["assign", "access", "hex"]
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "token_crc": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "package_crc": ["npm_"],
    "private_key": ["-----begin "],
    "webhook": ["hooks.slack.com/services/"],
}
HEX_DIGITS = 16
HEX_SYMBOL = "\x01"
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
PATTERNS = {
    "assign": rb"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": rb"AKIA[A-Z0-9]+",
    "hex": rb"[0-9a-f]+",
    "token_crc": rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])",
    "package_crc": rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])",
    "private_key": rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[^-]+-----END (?:[A-Z]+ )*PRIVATE KEY-----",
    "webhook": rb"hooks\.slack\.com/services/T[A-Z0-9]{8,}/B[A-Z0-9]{8,}/[A-Za-z0-9]{24}",
}

_HEX_MAP = bytes(1 if chr(b) in "0123456789abcdef" else 2 for b in range(256))
_COMPILED = {kind: re.compile(p) for kind, p in PATTERNS.items()}
_state: dict[str, ahocorasick.Automaton] = {}


def checksum_holds(payload: bytes, check: bytes) -> bool:
    """The last six characters are the payload's CRC-32 in base 62."""
    value, digits = zlib.crc32(payload), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = ALPHABET[digit] + digits
    return digits == check.decode()


def _accepted(kind: str, found: re.Match) -> bool:
    if kind == "assign":
        return found.end(1) - found.start(1) >= 12
    if kind == "access":
        return found.end() - found.start() >= 18
    if kind == "hex":
        return found.end() - found.start() >= HEX_DIGITS
    if kind.endswith("_crc"):
        return checksum_holds(found[1], found[2])
    return True


def _automaton() -> ahocorasick.Automaton:
    if "a" not in _state:
        made = ahocorasick.Automaton()
        for kind, keywords in KEYWORDS.items():
            for word in keywords:
                made.add_word(word, (kind, len(word)))
        made.add_word(HEX_SYMBOL * HEX_DIGITS, ("hex", HEX_DIGITS))
        made.make_automaton()
        _state["a"] = made
    return _state["a"]


def find_secrets(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind as listed."""
    automaton, found = _automaton(), []
    free = dict.fromkeys(KINDS, 0)
    for view in (text.translate(LOWER_ASCII), text.translate(_HEX_MAP)):
        for last, (kind, length) in automaton.iter(view.decode("latin-1")):
            start = last + 1 - length
            if start < free[kind]:
                continue
            match = _COMPILED[kind].match(text, start)
            if match:
                free[kind] = match.end()
                if _accepted(kind, match):
                    found.append((kind, start, match.end()))
    if found and len(text) != (total := len(text.decode("utf-8", "surrogatepass"))):
        cuts = sorted({p for _, a, b in found for p in (a, b)})
        ahead = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        at = {p: int(ahead[p - 1]) if p else 0 for p in cuts}
        assert total == int(ahead[-1])
        found = [(kind, at[a], at[b]) for kind, a, b in found]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(data: np.ndarray, offsets: np.ndarray) -> dict[str, list]:
    spans = [find_secrets(t) for t in texts_of(data, offsets)]
    base = [[x for x in own if x[0] in BASE_KINDS] for own in spans]
    return {
        **{f"n_{k}": [sum(x[0] == k for x in own) for own in base] for k in BASE_KINDS},
        "base_spans": [_written(x) for x in base],
        "spans": [_written(x) for x in spans],
        "n_verified": [sum(x[0].endswith("_crc") for x in own) for own in spans],
    }


def scan_secrets(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with counts and spans of the secrets in each whole text.

    Adds ``n_assign``, ``n_access``, ``n_hex`` (long), ``base_spans``, ``spans`` (kind:start:end, joined by commas) and
    ``n_verified`` (secrets whose checksum holds). One pass, no shuffle.
    """
    fields = {f"n_{k}": "long" for k in BASE_KINDS} | {
        "base_spans": "string",
        "spans": "string",
        "n_verified": "long",
    }
    return append_columns(docs, text, fields, _scan, keep_text)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_secrets(docs, keep_text=False).selectExpr(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "sha2(base_spans, 256) AS base_sha256",
        "spans",
        "n_verified",
    )
