"""Plain versions of the operators, for small inputs."""

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import xxhash

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
KINDS = ["assign", "access", "hex"]


def digest(text):
    return sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def rank(doc_id):
    return (1 << 63) - 1 if doc_id is None else doc_id


def secrets(text):
    rules = {
        "assign": (
            r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            lambda m: len(m[2]) >= 12,
        ),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    }
    found = [(k, m.start(), m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text, re.A) if ok(m)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def linked(n, near):
    """Smallest member of each component."""
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i + 1, n):
            if near(i, j) and root(i) != root(j):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(n)]


def fingerprint(text):
    words = (text or "").encode().translate(LOWER).split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(docs):
    """{(doc_id, text): (fingerprint, component)} of (doc_id, text) rows."""
    rows = sorted(set(docs), key=lambda r: (rank(r[0]), r[1] or ""))
    prints = [fingerprint(t) for _, t in rows]
    roots = linked(len(rows), lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 4)
    return {r: (f"{p:016x}", rows[k][0]) for r, p, k in zip(rows, prints, roots, strict=True)}


def without_words(docs, window):
    """{(doc_id, text): (n_words, n_removed, kept)}."""
    tokens = {(d, t): (t or "").encode().split() for d, t in docs}
    first = {}
    for (d, _), w in tokens.items():
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, rank(d)), rank(d))
    out = {}
    for (d, t), w in tokens.items():
        hit = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < rank(d):
                hit[i : i + window] = [True] * window
        kept = b" ".join(x for x, h in zip(w, hit, strict=True) if not h)
        out[d, t] = (len(w), sum(hit), kept.decode())
    return out


def without_lines(docs, window, words=5):
    """{(doc_id, text): (n_lines, n_removed, kept)}; ids must be distinct where texts differ. A line of so many words is a run too."""
    out, seen = {}, set()
    for d, t in sorted(set(docs), key=lambda r: rank(r[0])):
        if t is None:
            out[d, t] = (0, 0, None)
            continue
        own, hit = t.split("\n"), [False] * len(t.split("\n"))
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            if key in seen:
                hit[i : i + window] = [True] * window
            seen.add(key)
        for i, line in enumerate(own):
            if len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= words:
                hit[i] |= line in seen
                seen.add(line)
        out[d, t] = (len(own), sum(hit), "\n".join(x for x, h in zip(own, hit, strict=True) if not h))
    return out


def benchmark_words(text):
    lowered = (text or "").encode().translate(LOWER).decode()
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contamination(docs, items, window=13):
    """{(doc_id, text): (n_words, hit words, items, contaminated)}."""
    windows = defaultdict(set)
    for item, text in items:
        w = benchmark_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i : i + n])].add(item)
    lengths, out = {len(k) for k in windows}, {}
    for d, t in docs:
        w = benchmark_words(t)
        hit, found = [False] * len(w), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    found |= windows[tuple(w[i : i + n])]
                    hit[i : i + n] = [True] * n
        share = sum(hit) > 0 and 20 * sum(hit) >= len(w)
        out[d, t] = (len(w), hit, {x for x in found if x is not None}, share)
    return out


def held_out(doc_id, modulus, rest):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == rest


def word_scores(docs):
    """{(doc_id, text): (n_tokens, n_known, N, base)}."""
    tokens = {(d, t): [*(t or "").encode().translate(LOWER).split(), None] for d, t in docs}
    count = Counter(x for (d, _), w in tokens.items() if not held_out(d, 5, 1) for x in w)
    n, v = sum(count.values()), len(count)
    return {
        k: (len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        for k, w in tokens.items()
    }


def vector_links(vectors, threshold):
    """[(links, component)] of (vec_id, vector) rows with distinct ids."""

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float)
        return x / np.sqrt((x * x).sum())

    rows = sorted(vectors, key=lambda r: r[0])
    units = [unit(v) for _, v in rows]

    def near(i, j):
        a, b = units[i], units[j]
        return a is not None and b is not None and len(a) == len(b) and float(a @ b) >= threshold

    n = len(rows)
    roots = linked(n, near)
    return {rows[i][0]: (sum(near(i, j) for j in range(n) if j != i), rows[roots[i]][0]) for i in range(n)}


PERSONAL = ["email", "ip", "card", "phone"]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(x) for x in digits])):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def personal(text):
    """(kind, start, end) of the base entities, by kind as listed and start."""

    def n_digits(m):
        return re.sub(r"[^0-9]", "", m[0])

    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda m: all(int(x) <= 255 for x in m[0].split(".")),
        ),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(n_digits(m)) <= 19 and luhn(n_digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(n_digits(m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text, re.A) if ok(m)]


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def search(docs, items, k=10):
    """(item_id, rank, doc_id, score) of ranked search over rows (doc_id, text) and (item_id, text)."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    counts = [(d, Counter(re.findall(pattern, lowered(t)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    own = defaultdict(set)
    for i, t in items:
        own[i] |= set(re.findall(pattern, lowered(t)))
    out = []
    for i, terms in own.items():
        scored = []
        for d, c in counts:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms
                if c[t]
            )
            if score > 0:
                scored.append((-score, rank(d), d))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:k])]
    return out


def divergence(docs, least=10, top=10):
    """(lang, source, part, item, value, rank) over rows (text, lang, source)."""
    pattern = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
    counts, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        own = Counter(re.findall(pattern, lowered(text)))
        counts[lang or "", source or ""].update(own)
        df[lang or ""].update(own.keys())

    out = []
    for lang in df:
        kept = {t for t, n in df[lang].items() if n >= least}
        v = len(kept)
        whole = Counter()
        for (g, _), c in counts.items():
            if g == lang:
                whole.update({t: c[t] for t in kept if c[t]})

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        sources = sorted(s for g, s in counts if g == lang)
        made = {s: shares(counts[lang, s]) for s in sources}
        q = shares(whole)
        for s in sources:
            p = made[s]
            pairs = [(-sum(f(p[t], made[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(p[t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, o.decode(), -x, r + 1) for r, (x, o) in enumerate(rows)]
    return out
