"""Document fingerprints by winnowing (native).

Words (runs of non-white-space) are hashed; a rolling (cyclic polynomial) hash of every
k words is built by doubling; of every window of w successive hashes the smallest is
kept, ties going to the rightmost, with its word position. Guarantee: two texts that
share k + w - 1 words in a row share a fingerprint, and nothing shorter than k words
is ever matched. ``full_fingerprint`` adds the same over code points (with single blanks
between words) where words are too few or too long for that: all of a text of fewer than
``FEW_WORDS`` words, and the words of more than ``LONG_WORD`` code points of any other. Texts
that share ``K_POINTS + POINT_WINDOW - 1`` code points there share a fingerprint.

All steps are array expressions on the row, so a text needs no shuffle. A window keeps
(hash without its last 5 bits, position mod 32) in one long; as a window has at most 32
hashes, the position is restored from the window's own.

Defined results: null and empty texts, and those of white space, have no fingerprint;
a text of fewer than k words has one hash over all its words, one of fewer than w
hashes a single window; equal texts have equal fingerprints; further columns travel
along untouched (the operator's own names avoid them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurekit.llm.common import free_name, written

K_WORDS = 5
WINDOW = 16
FEW_WORDS, LONG_WORD = 64, 32
K_POINTS, POINT_WINDOW = 5, 4
#: Documents per layout bucket when neighbours are looked up, and the largest bucket
#: table (rows of 24 bytes) that is broadcast; beyond it the join is a shuffle.
BUCKET_DOCS, BROADCAST_BUCKETS, QUANTILES = 2000, 100_000, 1000


_SPACE = r"[\x20\x09-\x0D]+"


def _rotl(x: Column, r: int) -> Column:
    return F.shiftleft(x, r).bitwiseOR(F.shiftrightunsigned(x, 64 - r)) if r % 64 else x


def _joined(n: int):
    """Hash of a run followed by a run of n words."""
    return lambda a, b: _rotl(a, n).bitwiseXOR(b)


def _ahead(col: str, by: int) -> tuple[Column, Column]:
    """``col`` without its last ``by`` elements, and without its first."""
    n = F.greatest(F.size(col) - by, F.lit(0))
    return F.slice(col, F.lit(1), n), F.slice(col, F.lit(by + 1), n)


def _later_min(a: Column, b: Column) -> Column:
    """The smaller hash of a window and one further right; ties go right."""
    return F.when(F.shiftright(b, 5) <= F.shiftright(a, 5), b).otherwise(a)


def fingerprint(df: DataFrame, text: str, hashes: str, positions: str,
                k: int = K_WORDS, window: int = WINDOW, points: bool = False) -> DataFrame:
    """``df`` with ``hashes`` array<bigint> and ``positions`` array<int>, in text order; of
    the words, or with ``points`` of the code points of the trimmed text."""
    if not 1 <= window <= 32:
        raise ValueError("window must be between 1 and 32")
    h, g, m, at = (free_name(df, c) for c in ("_h", "_g", "_m", "_at"))
    none = F.array().cast("array<bigint>")
    bare = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    df = df.withColumn(h, F.when(bare == "", none).otherwise(
        F.transform(F.split(bare, "" if points else _SPACE), lambda w: F.xxhash64(w))))
    df, have = df.withColumn(g, F.col(h)), 1
    for bit in bin(k)[3:]:
        left, right = _ahead(g, have)
        df = df.withColumn(g, F.zip_with(left, right, _joined(have)))
        have *= 2
        if bit == "1":
            n = F.greatest(F.size(g) - 1, F.lit(0))
            df = df.withColumn(g, F.zip_with(F.slice(g, F.lit(1), n), F.slice(h, F.lit(have + 1), n), _joined(1)))
            have += 1
    short = F.array(F.aggregate(h, F.lit(0).cast("bigint"), _joined(1)))
    grams = F.when(F.size(h) >= k, F.col(g)).when(F.size(h) > 0, short).otherwise(none)
    df = df.withColumn(m, F.transform(grams, lambda x, i: F.shiftleft(F.shiftright(F.xxhash64(x), 5), 5)
                                      .bitwiseOR(i.cast("bigint").bitwiseAND(F.lit(31)))))
    df = df.withColumn(g, F.size(m))  # from here on the number of hashes
    few = F.array(F.aggregate(F.col(m), F.get(F.col(m), F.lit(0)), _later_min))
    df = df.withColumn(h, F.when((F.col(g) > 0) & (F.col(g) < window), few))
    steps = int(math.log2(window))
    for by in [1 << i for i in range(steps)] + ([window - (1 << steps)] if window != 1 << steps else []):
        left, right = _ahead(m, by)
        df = df.withColumn(m, F.zip_with(left, right, _later_min))
    df = df.withColumn(m, F.coalesce(F.col(h), F.col(m)))
    # neighbouring windows with the same minimum hold the same packed value
    df = df.withColumn(at, F.when(F.size(m) > 0, F.filter(
        F.sequence(F.lit(0), F.size(m) - 1),
        lambda j: (j == 0) | (F.get(F.col(m), j) != F.get(F.col(m), j - 1)))).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(hashes, F.transform(at, lambda j: F.shiftright(F.get(F.col(m), j), 5)))
    df = df.withColumn(positions, F.transform(at, lambda j: (j + (
        (F.get(F.col(m), j).bitwiseAND(F.lit(31))).cast("int") - j).bitwiseAND(F.lit(31))).cast("int")))
    return df.drop(h, g, m, at)


def full_fingerprint(df: DataFrame, text: str, hashes: str, positions: str, parts: str | None = None) -> DataFrame:
    """``fingerprint`` by words, followed by that of the code points of what has too few or
    too long words; positions count words, then code points of those words joined by blanks.
    ``parts`` names a column for what ``likeness_by_parts`` needs: how many of the hashes are
    of words, and whether the code points are those of the whole text."""
    part, h, p = (free_name(df, c) for c in ("_part", "_ph", "_pp"))
    words = F.split(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r")), _SPACE)
    df = df.withColumn(part, words)
    if parts:
        df = df.withColumn(parts, F.size(part) < FEW_WORDS)
    df = df.withColumn(part, F.array_join(F.when(F.size(part) < FEW_WORDS, F.col(part)).otherwise(
        F.filter(part, lambda w: F.length(w) > LONG_WORD)), " "))
    df = fingerprint(df, part, h, p, K_POINTS, POINT_WINDOW, points=True)
    df = fingerprint(df, text, hashes, positions)
    if parts:
        df = df.withColumn(parts, F.struct(F.size(hashes).alias("words"), F.col(parts).alias("whole")))
    return (df.withColumn(hashes, F.concat(hashes, h)).withColumn(positions, F.concat(positions, p)).drop(part, h, p))


def as_string(hashes: str, positions: str) -> Column:
    """``hash:position`` pairs, blank between, in text order."""
    return F.array_join(F.zip_with(hashes, positions, lambda a, b: F.concat(F.lower(F.hex(a)), F.lit(":"), b)), " ")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two fingerprints' hash sets; 1 for two empty ones."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(both / either)


def likeness_by_parts(a: str, a_parts: str, b: str, b_parts: str) -> Column:
    """``likeness`` of like with like: where the code points of one text are hashed as a whole and
    those of the other are not (they lie on either side of ``FEW_WORDS``), the greater of the
    likeness of their word hashes and that of their code-point hashes; else of all hashes."""
    def share(x: Column, y: Column) -> Column:
        return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))), F.lit(0.0))

    def part(h: str, p: str, of_words: bool) -> Column:
        n = F.col(p)["words"]
        return F.slice(h, F.lit(1), n) if of_words else F.slice(h, n + 1, F.size(h) - n)

    words, points = (share(part(a, a_parts, w), part(b, b_parts, w)) for w in (True, False))
    return F.when(F.col(a_parts)["whole"] == F.col(b_parts)["whole"], likeness(a, b)).otherwise(F.greatest(words, points))


def with_next(docs: DataFrame, cols: list[str], derive) -> DataFrame:
    """``derive(docs)``, which must keep all columns, with ``next_<c>`` for each of ``cols``: the value in the next
    document by descending doc_id (nulls last; equal ids by text hash), after the last
    the first. Documents are dealt to buckets by doc_id range (quantiles, split evenly),
    each bucket also gets the first row of the one after it, and ``lead`` runs within
    buckets: the texts are shuffled once and no task sees them all."""
    th, b, end, hb, hid, hth = (free_name(docs, x) for x in ("_th", "_b", "_end", "_hb", "_hid", "_hth"))
    keyed = docs.withColumn(th, F.xxhash64("text"))
    n, lo, hi = docs.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    n_cells = min(QUANTILES, max(1, math.ceil(n / BUCKET_DOCS)))
    split = max(1, math.ceil(n / BUCKET_DOCS / n_cells))
    bounds = []
    if n_cells > 1 and lo is not None:
        bounds = sorted(set(docs.agg(F.percentile_approx(
            "doc_id", [i / n_cells for i in range(1, n_cells)], 20 * n_cells)).first()[0]))
    if lo is None:
        bucket = F.lit(0).cast("long")
    else:
        edges = F.array(*[F.lit(e).cast("long") for e in [lo, *bounds, hi + 1]])
        cell = F.size(F.filter(edges, lambda e: e <= F.col("doc_id")))  # 1 to len(edges) - 1, 0 for a null
        first, after = F.get(edges, cell - 1), F.get(edges, cell)
        share = (F.col("doc_id") - first).cast("double") / (after - first).cast("double")
        sub = F.least(F.floor(share * split), F.lit(split - 1))
        bucket = F.coalesce(cell * split + sub, F.lit(0)).cast("long")
    keyed = keyed.withColumn(b, bucket)
    heads = keyed.groupBy(F.col(b).alias("b")).agg(F.max_by(F.struct(F.col("doc_id").alias("id"), F.col(th).alias("th")), F.struct(
        F.col("doc_id").isNotNull(), "doc_id", th)).alias("head"))
    down = Window.orderBy(F.desc("b"))  # one row per bucket
    heads = written(heads.select("b", F.coalesce(F.lead("head").over(down), F.first("head").over(
        down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("h")), "bucket-heads")
    small = heads.select(F.col("b").alias(hb), F.col("h.id").alias(hid), F.col("h.th").alias(hth))
    if heads.count() <= BROADCAST_BUCKETS:
        small = F.broadcast(small)
    ends = (keyed.drop(b).join(small, F.col("doc_id").eqNullSafe(F.col(hid)) & F.col(th).eqNullSafe(F.col(hth)))
            .withColumnRenamed(hb, b).drop(hid, hth).dropDuplicates([b]))
    rows = keyed.withColumn(end, F.lit(0)).unionByName(ends.withColumn(end, F.lit(1)))
    order = Window.partitionBy(b).orderBy(end, F.col("doc_id").desc_nulls_last(), F.desc(th))
    rows = derive(rows)
    return (rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in cols])
            .where(F.col(end) == 0).drop(end, b, th))
