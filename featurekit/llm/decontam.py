"""Benchmark decontamination by a prefix-filtered set join.

A document contains a benchmark window (10 successive item words; an item of fewer is
one window) only if it contains every 3-word shingle of it, so one shingle per window,
its necessary prefix at containment 1, decides whether to look further. Shingles are
ordered by rarity over all documents (counted in a first pass), and the rarest of each
window is the one that is joined. A match at document position p of the shingle at
offset o gives the only possible start p - o: it must not lie before the text's first
word, and the window must end by its last (positional and length bounds); then the
words are compared one by one, so no result rests on a hash.

The benchmark is the stated query set: it is indexed in blocks of bounded size, each
joined with all documents; a document goes through a block's index in one task and is
never shuffled. Between blocks the table is written to the shared folder.

Words: A-Z lower-cased, runs of digits, a-z and non-ASCII code points. Defined results:
null and empty texts, and items, have no words and no windows; equal items or windows
count once per item_id; a null item_id is the string ``null``; empty tables give no hits;
further columns of the documents travel along (the operator's own names avoid them).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import free_name, written
from featurekit.session import ship_package

WINDOW = 10
SHINGLE = 3
#: Benchmark text per index block, in bytes; ids of its words must fit 21 bits.
BLOCK_BYTES = 4 << 20
#: Candidates compared at a time.
STEP = 1 << 16

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words_of(text) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def _keys(ids: np.ndarray, n: int) -> np.ndarray:
    """A key per position for the n words there; 0 where one is not in the index."""
    if len(ids) < n:
        return np.zeros(0, np.int64)
    m = len(ids) - n + 1
    key, known = ids[:m] << 42, ids[:m] > 0
    for j in range(1, n):
        key = key | ids[j:j + m] << (42 - 21 * j)
        known &= ids[j:j + m] > 0
    return np.where(known, key, 0)


class Index:
    """The windows of a block of items, found by one shingle each."""

    def __init__(self, items: list[tuple[str, str]]):
        self.vocab: dict[bytes, int] = {}
        windows: dict[tuple, set] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            n = min(WINDOW, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                windows.setdefault(tuple(ids[i:i + n]), set()).add(item)
        if len(self.vocab) >= 1 << 21:
            raise ValueError("benchmark block has too many words; lower BLOCK_BYTES")
        self.items = [sorted(s) for s in windows.values()]
        self.lens = np.array([len(w) for w in windows], np.int64)
        self.words = np.full((len(windows), WINDOW), -1, np.int64)
        for i, w in enumerate(windows):
            self.words[i, :len(w)] = w
        # every shingle of every window: (key, window, offset), by shingle length
        self.shingles = []
        for i, w in enumerate(windows):
            ids = np.array(w, np.int64)
            for o, key in enumerate(_keys(ids, min(SHINGLE, len(w))).tolist()):
                self.shingles.append((key, i, o))
        self.keys = np.unique(np.array([s[0] for s in self.shingles], np.int64))
        self.sizes = sorted({min(SHINGLE, int(n)) for n in self.lens})
        self.prefix = None

    def ids(self, text) -> np.ndarray:
        get = self.vocab.get
        words = words_of(text)
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def found(self, ids: np.ndarray, keys: np.ndarray):
        """(position, index into ``keys``) of the shingles present."""
        for n in self.sizes:
            k = _keys(ids, n)
            pos = np.flatnonzero(k)
            if len(pos):
                at = np.searchsorted(keys, k[pos])
                ok = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == k[pos])
                if ok.any():
                    yield pos[ok], at[ok]

    def order(self, counts: dict[int, int]) -> None:
        """Keep the rarest shingle of each window (ties: the smaller key, then offset)."""
        best: dict[int, tuple] = {}
        for key, i, o in self.shingles:
            rank = (counts.get(key, 0), key, o)
            if i not in best or rank < best[i]:
                best[i] = rank
        rows = sorted((r[1], i, r[2]) for i, r in best.items())
        self.prefix, self.first = np.unique(np.array([r[0] for r in rows], np.int64), return_index=True)
        self.first = np.append(self.first, len(rows))
        self.window = np.array([r[1] for r in rows], np.int64)
        self.offset = np.array([r[2] for r in rows], np.int64)
        self.shingles, self.keys = [], None

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence in a document."""
        out = []
        span = np.arange(WINDOW)
        for pos, at in self.found(ids, self.prefix):
            ends = np.cumsum(self.first[at + 1] - self.first[at])
            lo = 0
            while lo < len(pos):  # a bounded number of candidates at a time
                base = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, base + STEP, "right")))
                n = (self.first[at[lo:hi] + 1] - self.first[at[lo:hi]])
                row = np.repeat(self.first[at[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                win, start = self.window[row], np.repeat(pos[lo:hi], n) - self.offset[row]
                ok = (start >= 0) & (start + self.lens[win] <= len(ids))
                win, start = win[ok], start[ok]
                at_words = np.minimum(start[:, None] + span, len(ids) - 1)
                same = (ids[at_words] == self.words[win]) | (span >= self.lens[win][:, None])
                ok = same.all(axis=1)
                out.append((win[ok], start[ok]))
                lo = hi
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def merged(starts, ends) -> tuple[list[int], list[int]]:
    """Spans united where they touch, in order."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [s[0] for s in out], [s[1] for s in out]


def _counter(shared):
    def count(batches):
        index = shared.value
        total = np.zeros(len(index.keys), np.int64)
        for pdf in batches:
            for text in pdf.iloc[:, 0]:
                for _, at in index.found(index.ids(text), index.keys):
                    total += np.bincount(at, minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"key": index.keys[at], "n": total[at]})
    return count


def _matcher(shared):
    def match(text: pd.Series, starts: pd.Series, ends: pd.Series, items: pd.Series) -> pd.DataFrame:
        index, rows = shared.value, []
        for t, s, e, had in zip(text, starts, ends, items, strict=True):
            ids = index.ids(t)
            win, at = index.hits(ids)
            if len(win):
                s, e = merged([*s, *at.tolist()], [*e, *(at + index.lens[win]).tolist()])
                had = sorted({*had, *(i for w in np.unique(win).tolist() for i in index.items[w])})
            rows.append((len(ids), list(s), list(e), list(had)))
        return pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])
    return F.pandas_udf(match, "n_words long, starts array<long>, ends array<long>, items array<string>")


def annotate(docs: DataFrame, benchmark: DataFrame, out: str = "leak", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with struct ``out``: n_words, starts, ends (hit spans in words, disjoint,
    ascending) and items (ids found, sorted as strings)."""
    spark = docs.sparkSession
    ship_package(spark)
    out = free_name(docs, out)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    n_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(n_bytes / block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks))
    none = "cast(array() as array<long>)"
    docs = docs.withColumn(out, F.expr(f"named_struct('n_words', 0L, 'starts', {none}, 'ends', {none}, "
                                       "'items', cast(array() as array<string>))"))
    for b in range(n_blocks):
        index = Index([tuple(r) for r in items.where(block == b).collect()])
        if not len(index.lens) and n_blocks > 1:
            continue
        shared = spark.sparkContext.broadcast(index)
        counts = (docs.select("text").mapInPandas(_counter(shared), "key long, n long")
                  .groupBy("key").agg(F.sum("n").alias("n")))
        index.order({r["key"]: r["n"] for r in counts.collect()})  # one row per shingle of the block
        shared = spark.sparkContext.broadcast(index)
        had = F.col(out)
        docs = docs.withColumn(out, _matcher(shared)(F.col("text"), had["starts"], had["ends"], had["items"]))
        if b + 1 < n_blocks:
            docs = written(docs, "decontam")
    return docs


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, columns unchanged."""
    out = free_name(docs, "leak")
    marked = annotate(docs, benchmark, out)
    return marked.where(F.size(F.col(out)["starts"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
