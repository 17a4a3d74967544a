"""MinHash near-duplicates by a signature-coordinate inverted join.

A document's set holds its distinct word n-grams (64-bit hashes). Documents of equal sets
form a class; only classes are joined. A class has a signature of ``COORDINATES`` minima,
one for each of as many hash functions; two sets agree in a coordinate with the
probability of their Jaccard similarity.

1. Posting. Every class is posted under each of its coordinate-value pairs, and the
   postings are counted. A posting of one class is no collision. A class left with fewer
   than ``matches`` postings links with nothing and is done.
2. Prefix. The postings left are ordered rare ones first. Two classes that collide in
   ``matches`` coordinates or more share one of the first k - matches + 1 of the k postings of
   either; only those stay in the inverted lists.
3. Merging. The lists are merged into collision counts of pairs, but a list's classes are not
   paired with each other: first with one pivot a list, another in each round, the best
   pivot of a class being tried; then components are formed, and only lists that still span
   several go on. Their classes are compared in the tasks that hold a block of the list.
   Collisions are counted a few coordinates at a time, and a pair that cannot reach
   ``matches`` with the coordinates left is skipped. Of the lists that a pair shares, one gives it.
4. Check. A pair kept is compared by size and by a parity sketch, whose distance never
   exceeds the symmetric difference, and then by the whole sets, which alone decide.

The match threshold is so low (``match_threshold``) that a pair that links misses it with a
probability of under 1e-11. No class is dropped or capped on the way.

Words: A-Z lower-cased, runs of non-white-space. Defined results: texts without words (null,
empty, white space) have empty sets and link with nothing; a text of fewer words than n
has its whole sequence as its one n-gram; equal rows link; a null doc_id is a document that
takes part but gives its group no id, and is kept only where its group has none; an empty table gives no
rows; other columns are left aside.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from featurekit.functions.sizing import broadcast_if_small
from featurekit.llm.common import written
from featurekit.llm.components import connected
from featurekit.llm.jaccard import Sketches, sketch, token_set
from featurekit.session import ship_package

COORDINATES = 64
#: Texts whose sets are held at a time, and tokens hashed at a time.
STEP, TOKENS = 500, 2048
#: Rounds of pivots before the lists' classes are compared with each other.
PIVOT_ROUNDS = 2
#: Classes of a list's block, pairs compared at a time, and coordinates counted at a time.
BLOCK, PAIRS, STRIDE = 1024, 1 << 17, 8
_RNG = np.random.default_rng(13)
_ODD = _RNG.integers(0, 1 << 63, (2, COORDINATES), np.uint64) * np.uint64(2) + np.uint64(1)
_BIT = np.uint64(1) << np.arange(COORDINATES, dtype=np.uint64)
_SALT = _RNG.integers(0, 1 << 63, COORDINATES, np.uint64)


def signature(tokens: np.ndarray) -> np.ndarray:
    """The set's minima under ``COORDINATES`` hash functions (int64). The functions are one to one and
    the result is mixed with its coordinate, so that equal values are collisions of one coordinate."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(tokens), TOKENS):
        h = tokens[None, at:at + TOKENS] ^ _SALT[:, None]
        h *= _ODD[0][:, None]
        h ^= h >> np.uint64(32)
        h *= _ODD[1][:, None]
        np.minimum(low, h.min(axis=1), out=low)
    low = (low ^ _SALT) * _ODD[0]
    return (low ^ (low >> np.uint64(29))).view(np.int64)


def match_threshold(percent: int, k: int = COORDINATES, miss: float = 1e-11) -> int:
    """The most collisions t of k coordinates such that a pair of that similarity has fewer
    with a probability under ``miss``."""
    p, below, t = percent / 100, 0.0, 0
    while t < k:
        below += comb(k, t) * p ** t * (1 - p) ** (k - t)
        if below >= miss:
            break
        t += 1
    return max(1, t)


def _texts(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, STEP):
            b = whole.slice(at, STEP)
            yield b.column(0), b.column(1).to_pylist()


_SET = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("sig", pa.list_(pa.int64())),
                  ("sketch", pa.binary())])


def _set_rows(n: int):
    def rows(batches):
        for ids, texts in _texts(batches):
            sets = [token_set(t, n) for t in texts]
            cols = [ids, [len(s) for s in sets], [xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    [signature(s) if len(s) else None for s in sets], [sketch(s) if len(s) else None for s in sets]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SET, strict=True)], schema=_SET)
    return rows


def _token_rows(n: int):
    def rows(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                sets = [token_set(t, n).tobytes() for t in whole.column(0).slice(at, STEP).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([xxh3_128_digest(x) for x in sets], pa.binary()),
                                                  pa.array(sets, pa.binary())], ["fp", "tokens"])
    return rows


class _Classes:
    """Sizes, signatures and sketches of the classes in a batch's columns."""

    def __init__(self, t, side: str = ""):
        column = {c: t.column(c + side) for c in ("n", "sig", "sketch")}
        column = {c: x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for c, x in column.items()}
        self.n = np.asarray(column["n"], np.int64)
        self.sig = np.asarray(column["sig"].flatten(), np.int64).reshape(-1, COORDINATES)
        self.sketch = Sketches(column["sketch"])


def _colliding(x: _Classes, i, y: _Classes, j, percent: int, matches: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (i of x, j of y) may link, and the collisions of those: sizes first, then
    collisions coordinate by coordinate, skipping what cannot reach the threshold, then sketches."""
    total = x.n[i] + y.n[j]
    least = -(-percent * total // (100 + percent))  # the smallest intersection that links
    at = np.flatnonzero(np.minimum(x.n[i], y.n[j]) >= least)
    count = np.zeros(len(at), np.int64)
    for c in range(0, COORDINATES, STRIDE):
        count += (x.sig[i[at], c:c + STRIDE] == y.sig[j[at], c:c + STRIDE]).sum(axis=1)
        live = count + (COORDINATES - c - STRIDE) >= matches
        at, count = at[live], count[live]
    live = x.sketch.apart(i[at], y.sketch, j[at]) <= (total - 2 * least)[at]
    return at[live], count[live]


def _pairs_kept(percent: int, matches: int):
    """Rows (cid, other, and both classes' columns): those that may link, with their collisions."""
    def rows(batches):
        for b in batches:
            each = np.arange(b.num_rows)
            at, count = _colliding(_Classes(b, "a"), each, _Classes(b, "b"), each, percent, matches)
            yield pa.RecordBatch.from_arrays([b.column("cid").take(pa.array(at)), b.column("other").take(pa.array(at)),
                                              pa.array(count, pa.int64())], ["cid", "other", "collisions"])
    return rows


def _block_pairs(percent: int, matches: int):
    """Pairs of different components in each run of equal (p, i, j); rows come sorted by it.
    Of two different blocks only pairs across are compared."""
    def pairs(t: pa.Table):
        change = np.zeros(t.num_rows, bool)
        change[0] = True
        for c in ("p", "i", "j"):
            v = np.asarray(t[c])
            change[1:] |= v[1:] != v[:-1]
        start = np.flatnonzero(change)
        end = np.repeat(np.append(start[1:], t.num_rows), np.diff(np.append(start, t.num_rows)))
        x, root, cid = _Classes(t), np.asarray(t["root"]), np.asarray(t["cid"])
        side, across = np.asarray(t["side"]), np.asarray(t["across"])
        prefix, own = np.asarray(t["prefix"]).view(np.uint64), x.sig == np.asarray(t["p"])[:, None]
        follow = end - np.arange(t.num_rows) - 1  # rows of the run after this one
        ends, lo = np.cumsum(follow), 0
        while lo < t.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
            left = np.repeat(np.arange(lo, hi), follow[lo:hi])
            right = left + 1 + np.arange(len(left)) - np.repeat(ends[lo:hi] - follow[lo:hi] - base, follow[lo:hi])
            differ = (root[left] != root[right]) & ((across[left] == 0) | (side[left] != side[right]))
            left, right = left[differ], right[differ]
            at, _ = _colliding(x, left, x, right, percent, matches)
            left, right = left[at], right[at]
            # a pair stands in every list that both have in their prefixes: the one of the lowest coordinate gives it
            common = ((x.sig[left] == x.sig[right]) * _BIT).sum(axis=1, dtype=np.uint64) & prefix[left] & prefix[right]
            this = (own[left] * _BIT).sum(axis=1, dtype=np.uint64)
            lowest = common & (~common + np.uint64(1)) == this
            both = np.sort(np.stack([cid[left[lowest]], cid[right[lowest]]]), axis=0)
            if both.size:
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])
            lo = hi

    def rows(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            last = np.ones(t.num_rows, bool)
            for c in ("p", "i", "j"):
                v = np.asarray(t[c])
                last &= v == v[-1]
            cut = t.num_rows if last.all() else int(np.flatnonzero(~last)[-1]) + 1
            if not last.all():
                yield from pairs(t.slice(0, cut).combine_chunks())
                t = t.slice(cut)
            held = t
        if held is not None:
            yield from pairs(held.combine_chunks())
    return rows


def _linked(percent: int):
    def rows(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("ta"), b.column("tb"), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(s, t, assume_unique=True))
                ok.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return rows


def components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    matches = match_threshold(percent)
    sets = written(docs.mapInArrow(_set_rows(n), "doc_id long, n long, fp binary, sig array<long>, sketch binary"),
                   "minhash-sets")
    classes = written(sets.where("n > 0").dropDuplicates(["fp"]).select(
        F.monotonically_increasing_id().alias("cid"), "fp", "n", "sig", "sketch"), "minhash-classes")

    posts = classes.select("cid", F.posexplode("sig").alias("c", "p"))
    lists = written(posts.groupBy("p").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "minhash-lists")
    shared = posts.join(lists, "p").groupBy("cid").agg(
        F.sort_array(F.collect_list(F.struct("k", "p", "c"))).alias("posts"))  # COORDINATES at most
    first = F.slice("posts", F.lit(1), F.size("posts") - matches + 1)
    bits = F.aggregate(first, F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), y["c"])))
    prefix = written(shared.where(F.size("posts") >= matches).select(
        "cid", first["p"].alias("ps"), bits.alias("prefix")), "minhash-prefixes")
    posted = prefix.select("cid", "prefix", F.explode("ps").alias("p"))
    several = posted.groupBy("p").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("p")
    lists = written(posted.join(several, "p"), "minhash-prefix-lists")

    tokens = _token_table(docs, sets, classes.select("cid", "fp").join(lists.select("cid").distinct(), "cid"), n)

    def candidates(pairs: DataFrame) -> DataFrame:
        """Pairs (cid, other) that may link, with their collisions."""
        a, b = (classes.select(F.col("cid").alias(c), *(F.col(x).alias(f"{x}{s}") for x in ("n", "sig", "sketch")))
                for c, s in (("cid", "a"), ("other", "b")))
        return pairs.join(a, "cid").join(b, "other").select(
            "cid", "other", "na", "siga", "sketcha", "nb", "sigb", "sketchb").mapInArrow(
            _pairs_kept(percent, matches), "cid long, other long, collisions long")

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = (tokens.select(F.col("cid").alias(x), F.col("tokens").alias(f"t{x}")) for x in ("a", "b"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(_linked(percent), "a long, b long")

    links, open_ = None, lists
    for step in range(PIVOT_ROUNDS + 1):
        if step < PIVOT_ROUNDS:
            pivots = open_.groupBy("p").agg(F.min_by("cid", F.xxhash64("cid", F.lit(step))).alias("other"))
            met = candidates(open_.join(pivots, "p").where("cid != other").select("cid", "other").distinct())
            best = met.groupBy("cid").agg(F.max(F.struct("collisions", "other"))["other"].alias("other"))
            pairs = best.select(F.least("cid", "other").alias("a"), F.greatest("cid", "other").alias("b"))
        else:
            pairs = _in_blocks(open_, classes, percent, matches)
        found = written(verified(pairs.distinct()), "minhash-links")
        links = found if links is None else links.union(found)
        roots = connected(links).select(F.col("v").alias("cid"), "root")
        if step == PIVOT_ROUNDS:
            break
        rooted = lists.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
        still = rooted.groupBy("p").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        open_ = written(rooted.join(still.select("p"), "p"), "minhash-open")
        if open_.isEmpty():
            break

    firsts = sets.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("first")).join(
        classes.select("fp", "cid"), "fp").join(roots, "cid", "left")
    firsts = written(firsts.select("fp", "first", F.coalesce("root", "cid").alias("root")), "minhash-firsts")
    named = firsts.join(firsts.groupBy("root").agg(F.min("first").alias("component_id")), "root").select(
        "fp", "component_id")
    out = sets.where("n > 0").select("doc_id", "n", "fp").join(named, "fp").unionByName(
        sets.where("n = 0").select("doc_id", "n", "fp", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _token_table(docs: DataFrame, sets: DataFrame, fps: DataFrame, n: int) -> DataFrame:
    """(cid, tokens) of the classes ``fps`` (cid, fp): the texts of one doc_id a class are read again (those
    without an id as well), and the fingerprint decides which set is whose."""
    fps = written(fps, "minhash-met")
    ids = sets.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(fps, "fp").where(
        "doc_id IS NOT NULL").select("doc_id").distinct()
    texts = docs.join(broadcast_if_small(ids), "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
    found = texts.select("text").mapInArrow(_token_rows(n), "fp binary, tokens binary")
    return written(found.dropDuplicates(["fp"]).join(fps, "fp").select("cid", "tokens"), "minhash-tokens")


def _in_blocks(open_: DataFrame, classes: DataFrame, percent: int, matches: int) -> DataFrame:
    """Candidate pairs of different components. A list is dealt to blocks of about ``BLOCK``
    classes, and every two blocks meet in one place, so a long list is spread over many tasks."""
    sizes = open_.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k"))
    rows = open_.join(sizes, "p").join(classes.select("cid", "n", "sig", "sketch"), "cid").withColumn(
        "own", F.pmod(F.xxhash64("cid"), "k").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("p", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"),
                       (F.col("own") != F.col("other")).cast("int").alias("across"), "cid", "root", "prefix", "n", "sig", "sketch")
    return rows.repartition("p", "i", "j").sortWithinPartitions("p", "i", "j").mapInArrow(
        _block_pairs(percent, matches), "a long, b long")
