"""Fingerprints against a plain Python version: hashes, windows, the query's edited texts and likeness."""

import hashlib
import re
import struct

import pytest
from pyspark.sql import functions as F

from featurekit.llm import queries, winnow
from featurekit.llm.common import written

from .test_operators import documents

xxhash = pytest.importorskip("xxhash")
SMOKE = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def _long(b):
    x = xxhash.xxh64(b, seed=42).intdigest()
    return x - (1 << 64) if x >> 63 else x


def _rotl(x, r):
    x, r = x & (1 << 64) - 1, r % 64
    return (x << r | x >> 64 - r) & (1 << 64) - 1


def _fingerprint(units, k, w):
    """[(hash, position)] of a list of words or code points."""
    h = [_long(u.encode()) for u in units]
    runs = [h[i:i + k] for i in range(len(h) - k + 1)] or ([h] if h else [])
    grams = []
    for run in runs:
        g = 0
        for x in run:
            g = _rotl(g, 1) ^ (x & (1 << 64) - 1)
        grams.append(_long(struct.pack("<Q", g)) >> 5)
    out = []
    for i in range(max(1, len(grams) - w + 1) if grams else 0):
        win = grams[i:i + w]
        at = i + max(j for j, g in enumerate(win) if g == min(win))
        if not out or out[-1][1] != at:
            out.append((grams[at], at))
    return out


def _full(text):
    """(word part, code-point part, whole) as ``full_fingerprint`` states them."""
    bare = (text or "").strip(SPACE)
    words = re.split(f"[{SPACE}]+", bare) if bare else []
    whole = len(words) < winnow.FEW_WORDS
    rest = " ".join(words if whole else [x for x in words if len(x) > winnow.LONG_WORD]).strip(SPACE)
    return (_fingerprint(words, winnow.K_WORDS, winnow.WINDOW),
            _fingerprint(list(rest), winnow.K_POINTS, winnow.POINT_WINDOW), whole)


def _both(df):
    """Fingerprints of ``a`` and ``b``, each written: two in one plan are slow to plan."""
    df = written(winnow.full_fingerprint(df, "a", "h", "p", "s"), "a")
    return written(winnow.full_fingerprint(df, "b", "g", "q", "u"), "b")


def _share(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else None


def _near(a, b):
    if a[2] == b[2]:
        s = _share(a[0] + a[1], b[0] + b[1])
        return 1.0 if s is None else s
    return max(_share(a[0], b[0]) or 0.0, _share(a[1], b[1]) or 0.0)


def _string(f):
    return " ".join(f"{h & (1 << 64) - 1:x}:{p}" for h, p in f[0] + f[1])


def test_query_equals_plain_python(spark):
    texts = {d: t or "" for d, t in documents(spark).items()}
    order = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in queries.QUERIES["op9_fingerprints"](spark, SMOKE).collect()}
    assert len(got) == len(texts)
    for i, d in enumerate(order):
        t, after = texts[d], texts[order[(i + 1) % len(order)]]
        cut = len(t) // 3
        edited = t[:len(t) - cut] + after[:cut]
        mine, other = _full(t), _full(edited)
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"].lower() == _string(mine) and r["edited_fingerprint"].lower() == _string(other)
        assert abs(r["near_edited"] - _near(mine, other)) < 1e-12 and abs(r["near_next"] - _near(mine, _full(after))) < 1e-12


def test_no_cliff_where_an_edit_changes_the_number_of_words(spark):
    """55 to 75 words of which the last third is replaced by fewer, as many or more words."""
    rows = []
    for seed in range(3):
        for n in range(55, 76):
            words = [f"word{(i * 7919 + seed * 104729) % 9973}" for i in range(n)]
            for m in (n // 3 - 12, n // 3, n // 3 + 12):
                rows.append((" ".join(words), " ".join(words[:n - n // 3] + [f"new{seed}x{i}" for i in range(m)])))
    df = spark.createDataFrame(rows, "a string, b string")
    df = _both(df)
    near = [r["near"] for r in df.select(winnow.likeness_by_parts("h", "s", "g", "u").alias("near")).collect()]
    assert min(near) > 0.1 and sorted(near)[len(near) // 20] > 0.2  # 0.015 to 0.046 where kinds were mixed
    crossing = df.where(F.col("s.whole") != F.col("u.whole"))
    assert crossing.count() > 30


def test_parts_of_odd_texts(spark):
    texts = [None, "", " \n", "one", "日本語" * 200, "w " * 63, "w " * 64, "x" * 40 + " y" * 80]
    df = spark.createDataFrame([(t, u) for t in texts for u in texts], "a string, b string")
    df = _both(df)
    for r in df.withColumn("near", winnow.likeness_by_parts("h", "s", "g", "u")).collect():
        assert abs(r["near"] - _near(_full(r["a"]), _full(r["b"]))) < 1e-12
        assert r["a"] != r["b"] or r["near"] == 1
