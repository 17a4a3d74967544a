"""Hard negatives, tokenizer alignment and MinHash against brute force, on odd tables and the smoke table."""

import hashlib
import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from featurekit.llm import crosstok, minhash, strtree
from featurekit.llm import queries as Q
from tests.conftest import SMOKE
from tests.llm.conftest import frame

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
VECTORS = "vec_id long, label long, vector array<double>"


# ------------------------------------------------------------- hard negatives
def brute_negatives(rows, every=100, n_positives=5, n_negatives=10, scale=256):
    best = {}
    for i, label, v in rows:
        if None in (i, label) or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i not in best or (label, v) < best[i]:
            best[i] = (label, v)
    whole = {i: (label, [math.floor(scale * x) for x in v]) for i, (label, v) in best.items()}
    out = set()
    for a, (label, q) in whole.items():
        if a % every:
            continue
        score = sorted((-sum(x * y for x, y in zip(q, v, strict=False)), i) for i, (_, v) in whole.items() if i != a)
        positives = [(i, -s) for s, i in score if whole[i][0] == label][:n_positives]
        for p, ps in positives:
            fit = [(i, -s) for s, i in score if whole[i][0] != label and 30 * ps <= -100 * s <= 90 * ps][:n_negatives]
            out |= {(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(fit)}
    return out


def vectors(seed, n, d, labels, top=1.0, whole=False):
    rng = random.Random(seed)
    point = (lambda: float(rng.randint(0, 2))) if whole else (lambda: rng.uniform(-top, top))
    return [(i, rng.randrange(labels), [point() for _ in range(d)]) for i in range(n)]


@pytest.mark.parametrize("case", ["plain", "ties", "many labels", "one label", "large", "odd", "copies"])
def test_hard_negatives_match_brute_force(spark, case):
    rows = {"plain": lambda: vectors(1, 700, 8, 3), "ties": lambda: vectors(2, 600, 3, 4, whole=True),
            "many labels": lambda: vectors(3, 300, 4, 400), "one label": lambda: vectors(4, 300, 4, 1),
            "large": lambda: vectors(5, 120, 3, 2, top=1e6), "copies": lambda: [
                (i, i % 3 if i % 2 else 0, [0.5, 0.25] if i % 3 else [1.0, 0.1 * (i % 7)]) for i in range(900)],
            "odd": lambda: vectors(6, 220, 4, 3) + [
                (None, 1, [1.0]), (300, None, [1.0]), (400, 1, None), (500, 1, [1.0, None]), (600, 2, [float("nan")]),
                (700, 2, [float("inf")]), (800, 0, []), (900, 1, [0.5, 0.5]), (0, 1, [9.0] * 4), (100, 0, [-1.0] * 6)] * 2}[case]()
    got = strtree.hard_negatives(spark.createDataFrame(rows, VECTORS).withColumn("tile", F.lit(1)).repartition(5))
    assert {tuple(r) for r in got.collect()} == brute_negatives(rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hard_negatives_of_small_tiles_and_an_empty_table(spark):
    rows = vectors(7, 900, 5, 3)
    usable = strtree.usable(spark.createDataFrame(rows, VECTORS))
    tiles = strtree.pack(usable, tile_rows=130)
    assert tiles.count() > 6
    boxes = [strtree.Tile(r.asDict()) for r in tiles.collect()]
    assert sorted(i for t in boxes for i in t.ids.tolist()) == sorted(r[0] for r in rows)
    for t in boxes:  # the boxes bound every row's product
        q = np.array([[3.0, -100.0, 7.0, 0.0, 55.0]])
        for level, (lo, hi) in enumerate(t.bounds(q)):
            rows_in = strtree.LEAF * strtree.FANOUT ** level
            for node in range(lo.shape[1]):
                s = t.matrix[node * rows_in:(node + 1) * rows_in] @ q[0]
                assert (lo[0, node] <= s).all() and (s <= hi[0, node]).all()
    assert strtree.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0


# ------------------------------------------------------- tokenizer alignment
@pytest.fixture(scope="module")
def aligner():
    return crosstok.Aligner(A, B)


def whole_groups(al, text):
    """Groups of a text encoded whole, cut by the tokens' decoded bytes; None where these are not the text's."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = al.a.encode(" " + text, add_special_tokens=False).ids, al.b.encode(text)
    ends = []
    for ids, table in ((a, al.bytes_a), (b, al.bytes_b)):
        got = [table[i] for i in ids]
        if b"".join(got) != raw:
            return None
        ends.append(np.cumsum([len(x) for x in got]).tolist())
    out, i, j = [], 0, 0
    after = [{e: k + 1 for k, e in enumerate(x)} for x in ends]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        k, m = after[0][cut], after[1][cut]
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return out


def rendered(groups):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


def brute_alignment(al, docs):
    """Per row of (doc_id, text): the query's columns."""
    groups = [whole_groups(al, t) for _, t in docs]
    links = [Counter((p, q) for x, y in g or [] for p in x for q in y) for g in groups]
    count = Counter(k for one in links for k in one)
    most = Counter()
    for (p, _), n in count.items():
        most[p] = max(most[p], n)
    return [(i, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), sum(one.values()),
             sum(c for k, c in one.items() if count[k] == most[k[0]]), sum(c * count[k] for k, c in one.items()),
             hashlib.sha256(rendered(g).encode()).hexdigest() if g else "")
            for (i, _), g, one in zip(docs, groups, links, strict=True)]


def test_stretches_align_as_whole_texts(aligner):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\r", "l;", "²", "².", "ł", " \n", "a", "the", "don't", "'s", "1", "23", "é", "日本", "𐍈", "▁", "<0x41>", "</s>",
             "<|endoftext|>", "\x00", "\xa0", " ", "　", "\x1c", "\x85", ".", ",", "-", "ing", "🙂", "​", "ﬁ", "é", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    for text, codes in zip(texts, aligner.codes(texts), strict=True):
        want = whole_groups(aligner, text)
        assert (want is not None) == (bool(text) and all(aligner.numbers[c, 4] for c in codes)), repr(text)
        a, ends_a, b, ends_b, cuts = aligner.text(text)
        if want is not None:
            assert "".join(aligner.groups[c] for c in codes)[:-1] == rendered(want), repr(text)
            assert list(a) == [i for x, _ in want for i in x] and list(b) == [i for _, y in want for i in y]
            assert len(cuts) == len(want) and ends_a[-1] == ends_b[-1] == cuts[-1] == len(text.encode()) + 1
        else:
            assert not len(a) and not len(cuts)


def test_a_small_cache_changes_nothing(aligner, monkeypatch):
    texts = [f"word{i} and {i * 7} more\nlines of text {i % 5}" for i in range(200)]
    once = [crosstok._chunk(aligner, 0, [1], [t]).to_pydict() for t in texts]
    monkeypatch.setattr(crosstok, "CACHE", 3)
    monkeypatch.setattr(crosstok, "LEARN", 2)
    assert [crosstok._chunk(aligner, 0, [1], [t]).to_pydict() for t in texts] == once


def test_alignment_matches_brute_force_on_odd_tables(spark, aligner, odd, clashing, empty, monkeypatch):
    want = sorted(brute_alignment(aligner, [(r.doc_id, r.text) for r in odd.collect()]), key=str)
    for docs in (odd, clashing):
        assert sorted(map(tuple, crosstok.document_alignment(docs, A, B).collect()), key=str) == want
    assert crosstok.document_alignment(empty, A, B).count() == 0
    spans = crosstok.token_spans(odd, A, B).collect()
    assert sorted((r.doc_id or -1, len(r.a_ids), len(r.b_ids), len(r.cuts)) for r in spans) == sorted(
        (i or -1, *x) for i, *x in ((r[0], r[1], r[2], r[3]) for r in want))


def test_alignment_query(spark, aligner):
    got = Q.QUERIES["op12_token_alignment"](spark, SMOKE).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    assert sorted(map(tuple, got)) == sorted(brute_alignment(aligner, docs))


# -------------------------------------------------------------------- minhash
def shingles(text, n):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace(
        "\r", " ").split(" ") if w]
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_components(docs, n, percent):
    sets = [shingles(t, n) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, j in combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            up[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(docs):
        group = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        first = min(group, default=None)
        out.append((doc, len(sets[i]), first, doc == first))
    return sorted(out, key=str)


def test_minhash_matches_brute_force_on_odd_tables(spark, odd, clashing, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for n, percent in ((4, 80), (3, 50), (5, 100)):
        for docs in (odd, clashing):
            got = sorted(map(tuple, minhash.components(docs, n, percent).collect()), key=str)
            assert got == brute_components(rows, n, percent)
    assert minhash.components(empty).count() == 0


def test_minhash_links_over_several_rounds(spark, monkeypatch):
    """Chains and groups that share most of their words but do not all link, in blocks of three."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "PAIRS", 5)
    rng, rows = random.Random(11), []
    for g in range(12):
        words = [f"w{g}_{i}" for i in range(60)]
        for k in range(14):
            text = list(words)
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(60)] = f"x{rng.randrange(50)}"
            rows.append((len(rows), " ".join(text), "en", "a", 1))
    got = sorted(map(tuple, minhash.components(frame(spark, rows), 2, 80).collect()), key=str)
    assert got == brute_components([(r[0], r[1]) for r in rows], 2, 80)
    assert 12 < len({r[2] for r in got}) < len(rows)


def test_minhash_query(spark):
    got = sorted(map(tuple, Q.QUERIES["op13_minhash"](spark, SMOKE).collect()), key=str)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    assert got == brute_components(docs, 4, 80)


def test_signatures_collide_as_often_as_sets_are_alike():
    rng = np.random.default_rng(1)
    for n in (10, 300, 5000):
        same = []
        for _ in range(150):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            b = a.copy()
            b[:n // 10] = rng.integers(0, 1 << 63, n // 10, dtype=np.uint64)
            same.append((minhash.signature(a) == minhash.signature(b)).mean())
        alike = (n - n // 10) / (n + n // 10)
        assert abs(np.mean(same) - alike) < 0.02 and min(same) * 64 >= minhash.match_threshold(80)
    assert minhash.match_threshold(100) == minhash.COORDINATES and 20 < minhash.match_threshold(80) < 40
