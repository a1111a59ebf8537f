"""Operators that judge each text on its own: secrets, pieces, licenses."""

import random
import zlib

import numpy as np
import pytest
import sentencepiece

from hemline.llm import licenses, pieces, secret_scan
from hemline.llm.common import Index, flat_texts, lines, pieces as cut, run_hashes, words
from tests.llm import brute

MODEL = pieces.default_model()


def token(prefix, payload):
    value, digits = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = secret_scan.ALPHABET[digit] + digits
    return prefix + payload + digits


def test_base_secrets_equal_plain_expressions():
    rnd = random.Random(2)
    parts = [
        "password", "PassWord", "token", "api_key", "apikey", "secret", " ", '"', "'", ":", "=", "AKIA", "akia",
        "0123456789abcdef", "deadbeef", "é", "ABCDEF123456", "xyz_", "ſecret", "\n", "abc",
    ]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        found = [s for s in secret_scan.find_secrets(text.encode()) if s[0] in brute.KINDS]
        assert found == brute.secrets(text)


def test_checksums_decide():
    good = token("ghp_", "a1B2" * 7 + "zz")
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert [s[0] for s in secret_scan.find_secrets(f"é {good} {bad}".encode())] == ["token_crc"]
    assert secret_scan.find_secrets(f"é {good}".encode())[0][1:] == (2, 42)
    assert [s[0] for s in secret_scan.find_secrets(token("npm_", "Q" * 30).encode())] == ["package_crc"]


def test_secret_query_on_whole_table(spark, sample):
    from tests.llm.conftest import SF

    got = {r["doc_id"]: r for r in secret_scan.op1_secret_scan(spark, SF).collect()}
    assert len(got) == len(sample)
    for d, t in sample:
        base = brute.secrets(t or "")
        assert [got[d][f"n_{k}"] for k in brute.KINDS] == [sum(s[0] == k for s in base) for k in brute.KINDS]
        assert got[d]["base_sha256"] == brute.digest(",".join(f"{k}:{a}:{b}" for k, a, b in base))


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL, "rb") as file:
        return pieces.Encoder(file.read()), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(encoder, sample):
    own, library = encoder
    rnd = random.Random(1)
    letters = "abAB  ▁é漢\n\t.😀0=-ththe"
    texts = ["", "a" * 5000, " " * 99 + "x", "=-" * 700, *[t or "" for _, t in sample]]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 300))) for _ in range(200)]
    for text, (ids, decoded) in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded.decode() == library.decode(want)


def test_piece_cache_is_bounded(encoder, monkeypatch):
    own, library = encoder
    monkeypatch.setattr(pieces, "CACHE", 50)
    texts = [" ".join(f"q{i}x{j}" for j in range(30)) for i in range(20)]
    for text in texts:
        ids, _ = own.encode([text])[0]
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
        assert len(own.known) <= 80


def test_row_operators_on_odd_rows(frame, odd_rows, spark):
    docs = frame(odd_rows, "spans", "ids", "n_tokens", "licenses", "_ranges")
    scanned = secret_scan.scan_secrets(docs).collect()
    assert len(scanned) == len(odd_rows) and all(r["spans"] == "" and r["_ranges"] == "x" for r in scanned)
    encoded = {(r["doc_id"], r["text"]): r for r in pieces.encode_pieces(docs, MODEL).collect()}
    assert encoded[1, None]["ids"] == [1, 2] and encoded[1, None]["decoded"] == ""
    assert encoded[9, "A b C"]["decoded"] == "A b C"
    assert licenses.scan_licenses(docs).filter("n_licenses > 0").count() == 0
    assert {tuple(r["licenses"]) for r in licenses.scan_licenses(docs).collect()} == {()}
    none = frame([])
    for made in (secret_scan.scan_secrets(none), pieces.encode_digests(none, MODEL), licenses.scan_licenses(none)):
        assert made.count() == 0


def test_licenses_equal_exact_windows():
    rnd = random.Random(3)
    library = licenses.Library(licenses.TEMPLATES, 5, 0.8, 0.999)

    def plain(text):
        w, out = [x.encode() for x in brute.benchmark_words(text)], {}
        for name, template in licenses.TEMPLATES.items():
            t = [x.encode() for x in brute.benchmark_words(template)]
            k = min(5, len(t))
            m = len(t) - k + 1
            stride, own = max(1, m // 4), {tuple(t[i : i + k]) for i in range(m)}
            for at in range(0, max(0, len(w) - k + 1), stride):
                a, b = max(0, at - stride), min(min(at + m, len(w) - k + 1) + stride, len(w) - k + 1)
                hits = [p for p in range(a, b) if tuple(w[p : p + k]) in own]
                share = len({tuple(w[p : p + k]) for p in hits}) / len(own)
                if share >= 0.8:
                    out.setdefault(name, []).append((hits[0], hits[-1] + k, share))
        return {x[:3] for x in licenses._merged(out)}

    texts = []
    for _ in range(200):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            w = rnd.choice(list(licenses.TEMPLATES.values())).split()
            for _ in range(rnd.choice([0, 0, 0, 1, 2])):
                w[rnd.randrange(len(w))] = "zz"
            parts += [*w, *[f"word{rnd.randrange(50)}" for _ in range(rnd.randint(0, 30))]]
        texts.append(" ".join(parts))
    import pyarrow as pa

    found = library.find(*flat_texts(pa.array(texts)))
    want = [plain(t) for t in texts]
    n = sum(map(len, want))
    missed = sum(len(w - {x[:3] for x in f}) for w, f in zip(want, found, strict=True))
    assert n > 100 and missed <= 0.01 * n
    assert all({x[0] for x in f} <= {x[0] for x in w} for w, f in zip(want, found, strict=True))


def test_license_lines_of_the_documents(spark, sample):
    from tests.llm.conftest import SF

    got = {r["doc_id"]: r["licenses"] for r in licenses.op3_license_scan(spark, SF).collect()}
    for d, t in sample:
        for name, notice in licenses.TEMPLATES.items():
            if notice in (t or ""):
                assert name in got[d].split(",")


def test_byte_helpers():
    import pyarrow as pa

    texts = ["a bc\n", None, "", "\nx  y", "ß\tß"]
    data, offsets = flat_texts(pa.array(texts).slice(0, 5))
    starts, ends, first = words(data, offsets)
    assert [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] == [b"a", b"bc", b"x", b"y", "ß".encode(), "ß".encode()]
    assert first.tolist() == [0, 2, 2, 2, 4, 6]
    hashes = run_hashes(data, starts, ends)
    assert hashes[4] == hashes[5] and len(set(hashes.tolist())) == 5
    starts, ends, first = lines(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == ["a bc", "", "", "", "", "x  y", "ß\tß"]
    assert np.diff(first).tolist() == [2, 1, 1, 2, 1]
    assert list(cut(offsets, 4)) == [(0, 1), (1, 3), (3, 4), (4, 5)]
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    index = Index(keys)
    assert index.find(keys).tolist() == list(range(5000)) and (index.find(keys + 1) < 0).all()
    assert Index(keys[:0]).find(keys).max() == -1
