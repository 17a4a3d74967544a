"""Line deduplication by pairwise alignment.

Documents that share a line are found through the line's hash. A rare line (in at most
``RARE_DOCS`` documents) pairs each of its documents with every earlier one, at most
``RARE_DOCS - 1``; a line in more documents pairs each with its first holder only, and so
does a run of adjacent lines that just reaches ``MIN_WORDS`` words. Nothing makes pairs by
the square, and as such runs cover every block of that many words, every block that an
earlier document holds is aligned with some earlier holder.
Each pair is aligned by patience diff on the line hashes: lines unique in both are
matched along their longest increasing run, the gaps between are aligned in turn, and
matches grow over equal neighbours. What that leaves (lines that repeat, or stand in
another order) is looked up by runs of lines. A block of at least ``MIN_WORDS`` words that
the earlier document holds is deleted from the later one (by doc_id, then text hash),
wherever and however often it stands there; its first occurrence stays.

Pairs carry line hashes, not texts, and of those only what can match: a document is first
shortened to its stretches of lines that some other document holds too, where a stretch has
``MIN_WORDS`` words; what lies between two stretches becomes one break, which equals nothing.
A block that two documents share lies within one stretch of either, so nothing is lost.
Rare lines, runs and pairs are those of the shortened documents. The texts are only read
again, in one join, by documents that lose lines.

Lines are the text between line feeds. Lines without a word never pair, but blocks run
across them. Defined results: null and empty texts have no lines to lose; documents with
the same doc_id and text are one document, each row treated alike; a null doc_id comes
first in the order; a text whose lines all go becomes empty; an empty table gives
no rows; further columns travel along (n_chars follows the text).
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from featurekit.llm.common import free_name, written
from featurekit.session import ship_package

RARE_DOCS = 8
MIN_WORDS = 12
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def line_hashes(text: str) -> tuple[list[int], list[int]]:
    """(hash as signed 64 bits, words) of each line."""
    hashes, words = [], []
    for line in text.split("\n"):
        h = xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"))
        hashes.append(h - (1 << 64) if h >> 63 else h)
        words.append(len(line.split()))
    return hashes, words


def spans(words, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the shortest runs of ``min_words`` words from each line on and up
    to each line; they cover every longer block."""
    total = np.concatenate([[0], np.cumsum(np.maximum(np.asarray(words, dtype=np.int64), 0))])
    at = np.arange(len(total))
    ends = np.searchsorted(total, total + min_words, "left")
    starts = np.searchsorted(total, total - min_words, "right") - 1
    on, up = ends < len(total), starts >= 0
    return np.concatenate([at[on], starts[up]]), np.concatenate([ends[on], at[up]])


def span_hashes(hashes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the lines of each run, by differences of prefix sums (signed 64 bits)."""
    n = len(hashes)
    up, down = (np.cumprod(np.array([1] + [x] * n, dtype=np.uint64)) for x in (_BASE, _INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.asarray(hashes, dtype=np.int64).view(np.uint64) * up[:n])])
    return ((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)).view(np.int64)


def run_keys(hashes, words) -> list[int]:
    """Hashes of the runs of several lines, without a break, that start and end with a word."""
    starts, ends = spans(words)
    w = np.asarray(words, dtype=np.int64)
    if not len(starts):
        return []
    breaks = np.concatenate([[0], np.cumsum(w < 0)])
    several = (ends - starts > 1) & (w[starts] > 0) & (w[ends - 1] > 0) & (breaks[starts] == breaks[ends])
    return np.unique(span_hashes(hashes, starts[several], ends[several])).tolist()


def shortened(lines: np.ndarray, words: np.ndarray, shared: np.ndarray, own: int,
              min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, words, places in the document) of the stretches of shared lines, and lines
    without a word among them, that have ``min_words`` words. A break stands before each: -1
    words, and a hash made from ``own``, the text's."""
    stays = (words == 0) | np.isin(lines, shared)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], stays.astype(np.int8), [0]])))
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    at = [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if total[b] - total[a] >= min_words]
    if not at:
        return lines[:0], words[:0], np.zeros(0, np.int32)
    marks = (np.full(1, own, np.int64).view(np.uint64) + np.uint64(_BASE) * np.arange(1, len(at) + 1, dtype=np.uint64)).view(np.int64)
    pieces = [(np.concatenate([[mark], lines[a:b]]), np.concatenate([[-1], words[a:b]]), np.arange(a - 1, b))
              for mark, (a, b) in zip(marks, at, strict=True)]
    return tuple(np.concatenate(x) for x in zip(*pieces, strict=True))


def patience(a, b) -> list[tuple[int, int]]:
    """Aligned positions of equal elements, ascending in both (patience diff)."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        anchors = _increasing(_unique_matches(a, alo, ahi, b, blo, bhi))
        if not anchors:
            continue
        edges = [(alo - 1, blo - 1), *anchors, (ahi, bhi)]
        for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True):
            todo.append((i + 1, k, j + 1, m))
        out.extend(anchors)
    return sorted(out)


def _unique_matches(a, alo, ahi, b, blo, bhi) -> list[tuple[int, int]]:
    """(i, j) of the elements that occur once in either stretch, by i."""
    at: dict[int, int] = {}
    for j in range(blo, bhi):
        at[b[j]] = -1 if b[j] in at else j
    first: dict[int, int] = {}
    for i in range(alo, ahi):
        first[a[i]] = -1 if a[i] in first else i
    return [(i, at[x]) for x, i in first.items() if i >= 0 and at.get(x, -1) >= 0]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs that ascends in both, by patience piles."""
    tops, ends, back = [], [], []
    for n, (_, j) in enumerate(pairs):
        p = bisect.bisect_left(tops, j)
        back.append(ends[p - 1] if p else -1)
        if p == len(tops):
            tops.append(j)
            ends.append(n)
        else:
            tops[p], ends[p] = j, n
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def common_blocks(later, later_words, earlier, earlier_words, min_words: int = MIN_WORDS) -> list[int]:
    """Lines of the later document in blocks of at least ``min_words`` words that the
    earlier one holds: aligned ones, and then those that repeat or cross."""
    out, run, at = set(), [], None
    for i, j in [*patience(later, earlier), (-5, -5)]:
        if at is None or (i, j) != (at[0] + 1, at[1] + 1):
            if sum(later_words[x] for x in run) >= min_words:
                out.update(run)
            run = []
        run.append(i)
        at = (i, j)
    held = set(earlier)
    if _left(later, later_words, held, out, min_words):
        starts, ends = spans(later_words, min_words)
        found = np.isin(span_hashes(later, starts, ends), span_hashes(earlier, *spans(earlier_words, min_words)))
        edges = np.zeros(len(later) + 1, np.int64)
        np.add.at(edges, starts[found], 1)
        np.add.at(edges, ends[found], -1)
        out.update(np.flatnonzero(np.cumsum(edges[:-1])).tolist())
    return sorted(out)


def _left(later, words, held: set, gone: set, min_words: int) -> bool:
    """Whether a stretch of lines that the earlier document holds has enough words and a
    line that is not gone."""
    total, more = 0, False
    for i, (x, n) in enumerate(zip(later, words, strict=True)):
        if x not in held:
            total, more = 0, False
            continue
        total, more = total + n, more or i not in gone
        if more and total >= min_words:
            return True
    return False


def _lines(batches):
    for b in batches:
        hs, ws = [], []
        for t in b.column(2).to_pylist():
            h, w = line_hashes(t) if t else ([], [])
            hs.append(h)
            ws.append(w)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hs, pa.list_(pa.int64())),
                                          pa.array(ws, pa.list_(pa.int32()))], ["doc_id", "th", "lines", "words"])


def _shortened(batches):
    for b in batches:
        doc, th, lines, words, shared = (b.column(i) for i in range(5))
        ends, s_ends = lines.offsets.to_numpy(), shared.offsets.to_numpy()
        h, w, s = (x.values.to_numpy(zero_copy_only=False) for x in (lines, words, shared))
        kept = [shortened(h[a:z], w[a:z], s[i:j], own) for a, z, i, j, own in zip(
            ends, ends[1:], s_ends, s_ends[1:], th.to_pylist(), strict=False)]
        full = pa.array([len(k[0]) > 0 for k in kept], pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [doc, th, *(pa.array([k[i] for k in kept], pa.list_(t)) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32())))],
            ["doc_id", "th", "lines", "words", "at"]).filter(full)


def _run_keys(lines: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series([run_keys(a, w) for a, w in zip(lines, words, strict=True)])


def _align(later: pd.Series, words: pd.Series, at: pd.Series, earlier: pd.Series, earlier_words: pd.Series) -> pd.Series:
    return pd.Series([p[common_blocks(a.tolist(), w.tolist(), b.tolist(), v.tolist())].tolist()
                      for a, w, p, b, v in zip(later, words, at, earlier, earlier_words, strict=True)])


def _cut(text: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for t, gone in zip(text, dropped, strict=True):
        gone = set() if gone is None else set(np.asarray(gone).tolist())
        out.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone))
    return pd.Series(out)


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, dropped, partners): per document that loses lines, their indexes and
    the doc_ids of the earlier documents they are aligned with."""
    ship_package(docs.sparkSession)
    lines = written(docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        _lines, "doc_id long, th long, lines array<long>, words array<int>").dropDuplicates(["doc_id", "th"]), "lines")
    key = F.struct(F.col("doc_id"), F.col("th")).alias("key")

    def held_lines(rows: DataFrame) -> DataFrame:
        return rows.select(key, F.explode(F.array_distinct(F.transform(
            F.filter(F.arrays_zip("lines", "words"), lambda x: x["words"] > 0), lambda x: x["lines"]))).alias("line"))

    every = held_lines(lines)
    twice = every.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("line")
    # a document's shared lines: bounded by its text
    shared = every.join(twice, "line").groupBy("key").agg(F.collect_list("line").alias("shared"))
    short = written(lines.join(shared.select(F.col("key").alias("_key"), "shared"),
                               F.struct("doc_id", "th").eqNullSafe(F.col("_key")))
                    .select("doc_id", "th", "lines", "words", "shared")
                    .mapInArrow(_shortened, "doc_id long, th long, lines array<long>, words array<int>, at array<int>"), "short-lines")
    held = written(held_lines(short), "held-lines")
    per = held.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first")).where("n > 1")
    star = (held.join(per.where(F.col("n") > RARE_DOCS), "line").where(F.col("key") > F.col("first"))
            .select(F.col("key").alias("later"), F.col("first").alias("earlier")))
    # at most RARE_DOCS keys per list; the repartition leaves the join free to split the
    # partition of a line that is not rare
    rare = (held.join(per.where(F.col("n") <= RARE_DOCS).select("line"), "line").repartition("line")
            .groupBy("line").agg(F.sort_array(F.collect_list("key")).alias("keys")))
    rare = rare.select("keys", F.posexplode("keys").alias("at", "later")).select(
        "later", F.explode(F.slice("keys", F.lit(1), F.col("at"))).alias("earlier"))
    runs = written(short.select(key, F.explode(
        F.pandas_udf(_run_keys, "array<long>")("lines", "words")).alias("run")), "held-runs")
    of = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first")).where("n > 1")
    blocks = (runs.join(of, "run").where(F.col("key") > F.col("first"))
              .select(F.col("key").alias("later"), F.col("first").alias("earlier")))
    pairs = star.unionByName(rare).unionByName(blocks).distinct()

    whole = short.select(key, "lines", "words", "at")
    first = whole.select(F.col("key").alias("earlier"), F.col("lines").alias("from"), F.col("words").alias("from_words"))
    aligned = (pairs.join(first, "earlier").join(whole.withColumnRenamed("key", "later"), "later")
               .withColumn("gone", F.pandas_udf(_align, "array<int>")("lines", "words", "at", "from", "from_words"))
               .where(F.size("gone") > 0).select("later", "earlier", "gone"))
    # a document's lines: bounded by its text; its partners: by its lines times RARE_DOCS
    return (aligned.groupBy("later").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("dropped"),
                                         F.sort_array(F.collect_set("earlier.doc_id")).alias("partners"))
            .select(F.col("later.doc_id").alias("doc_id"), F.col("later.th").alias("th"), "dropped", "partners"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without the duplicate blocks, with ``dropped_lines`` (how many) and
    ``aligned_with`` (doc_ids)."""
    names = [c for c in docs.columns if c not in ("dropped_lines", "aligned_with")]
    d, t, h, gone, by = (free_name(docs, c) for c in ("_d", "_t", "_h", "_gone", "_by"))
    found = written(duplicate_lines(docs), "duplicate-lines").select(
        F.col("doc_id").alias(d), F.col("th").alias(t), F.col("dropped").alias(gone), F.col("partners").alias(by))
    rows = docs.select(*names).withColumn(h, F.xxhash64("text"))
    # the same join at every size: the texts are moved once, whether or not what was found would fit a broadcast
    rows = rows.join(found.hint("merge"), F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(h) == F.col(t)), "left")
    lost = F.col(gone).isNotNull()
    text = F.when(lost, F.pandas_udf(_cut, "string")(F.when(lost, F.col("text")).otherwise(F.lit("")), gone)).otherwise(
        F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*names, F.coalesce(F.size(gone), F.lit(0)).alias("dropped_lines"),
                       F.coalesce(by, F.array().cast("array<bigint>")).alias("aligned_with"))
