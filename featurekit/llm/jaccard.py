"""N-gram Jaccard self-join by token-combination prefixes.

A document's set holds its distinct word n-grams (64-bit hashes). Documents of equal
sets form a class; only classes are joined. Two sets link when
100 * intersection >= percent * union.

1. Head. A set of n tokens can lack at most e = n - ceil(percent * n / 100) of them in a
   set it links with, so of its first c = e + 1 + n/4 tokens by hash at least c - e stand
   in the other's head too (of the two, take the set whose head ends first). The heads'
   tokens are counted over all documents; one in a single head is in no such overlap. A
   set with too few shared head tokens links with nothing and is done: no row of it is
   ever shuffled.
2. Signatures. What remains of a head is ordered rare tokens first, then frequent ones
   (in more than ``FREQUENT`` heads), each by hash. A prefix of it must offer one signature
   more than the set may miss: a rare token is a signature of its own; frequent tokens
   are dealt to hash buckets, every 2-combination within a bucket is a signature, and c
   tokens of a bucket cost the opponent c - 1 misses. The prefix is extended until that
   suffices. As the buckets depend on the set's size, combinations are made for its size
   class and the next one: linked sets differ by one class at most. Size classes of
   under 16 tokens use single tokens only.
3. Candidates. Sets that share a signature are not paired with each other: each
   signature's sets are compared with one pivot (chosen by hash, a few different ones per
   group), links verified, components formed, and only signatures that still span several
   components go on. Their sets are compared by size and sketch inside the tasks that hold a
   block of the group, and only what passes becomes a row, once: of the signatures that two
   sets share the lowest gives the pair (told by each set's ``LOW`` lowest ones, so that a
   pair with none of those in common may come more often, and none is lost). First as many pairs as would
   join the components, and at last, of components still apart, every pair. No link that
   would join two components is missed. A candidate is verified by size, by a parity sketch whose distance
   never exceeds the symmetric difference, then by the sets themselves.

Which tokens are shared and which frequent is read from two bitmaps of fixed size. A bit
that another token set only adds work: the result is the same with any bitmap that holds
all shared tokens.

Words: A-Z lower-cased, runs of non-white-space. Defined results: texts without words
(null, empty, white space) have empty sets and link with nothing; a text of fewer words
than n has its whole sequence as its one n-gram; equal rows link; a null doc_id is a
document that takes part but gives its group no id; an empty table gives no rows; other
columns are left aside.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from featurekit.llm.common import free_name, written
from featurekit.llm.components import connected
from featurekit.session import ship_package

#: Bits of each bitmap (packed: 16 MB).
BITMAP_BITS = 1 << 27
FREQUENT = 32
#: Texts whose sets are held at a time.
STEP = 500
SMALL = 16
#: Bits of the shortest and the longest sketch.
SKETCH_BITS = (512, 8192)
PIVOT_KINDS = 8
#: Members of a group's block, and pairs compared at a time.
BLOCK = 1024
PAIRS = 1 << 19
#: Lowest signatures of a set that go with it.
LOW = 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def token_set(text, n: int) -> np.ndarray:
    """Distinct n-gram hashes, ascending (uint64)."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n_eff = min(n, len(h))
    m = len(h) - n_eff + 1
    g = np.full(m, n_eff, np.uint64)
    for j in range(n_eff):
        g = _mix(g * _ODD + h[j:j + m])
    g = np.sort(g)
    keep = np.ones(len(g), bool)
    np.not_equal(g[1:], g[:-1], out=keep[1:])
    return g[keep]


def misses(n: int, percent: int) -> int:
    return n + (-percent * n // 100)


def size_class(n: int, percent: int) -> int:
    """Sets that link differ by one class at most (classes are a trifle wider than the
    largest ratio of linked sizes)."""
    return int(math.log(n) / (math.log(100 / percent) + 1e-9))


def overlap(n: int, percent: int) -> int:
    """Tokens of a set's head that stand in the head of a set it links with, at least."""
    return min(n - misses(n, percent), 1 + -(-n // 4))


def head(tokens: np.ndarray, percent: int) -> np.ndarray:
    n = len(tokens)
    return tokens[:misses(n, percent) + overlap(n, percent)]


def signatures(tokens: np.ndarray, shared, frequent, percent: int):
    """Signature hashes (int64) of one set, or None where it links with nothing."""
    n = len(tokens)
    kept = head(tokens, percent)
    kept = kept[flagged(kept, shared)]
    # the linked set's head may be the one that ends first, and its set the smaller one
    need = len(kept) - overlap(-(-percent * n // 100), percent) + 1
    if need <= 0:
        return None
    is_frequent = flagged(kept, frequent)
    rare, often = kept[~is_frequent], kept[is_frequent]
    out = [rare[:need]]
    short = need - len(rare)
    if short > 0:
        c = size_class(n, percent)
        for g in (c, c + 1):
            like = math.exp(g * (math.log(100 / percent) + 1e-9))  # least size of the class
            if like < SMALL or percent < 71:
                out.append(often[:short])
                continue
            n_buckets = int(like) // 16
            bucket = (_mix(often * _ODD) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            counts = np.ones(len(often), np.int64)
            counts[order[np.r_[True, np.diff(bucket[order]) != 0]]] = 0  # a bucket's first token costs nothing
            length = int(np.searchsorted(np.cumsum(counts), short)) + 1
            order = np.argsort(bucket[:length], kind="stable")
            groups = np.split(often[:length][order], np.flatnonzero(np.diff(bucket[:length][order])) + 1)
            for t in groups:
                if len(t) > 1:
                    i, j = np.triu_indices(len(t), 1)
                    out.append(_mix(_mix(t[i] * _ODD + np.uint64(g + 1)) * _ODD + t[j]))
    return np.unique(np.concatenate(out)).view(np.int64)


def flagged(tokens: np.ndarray, bits: np.ndarray) -> np.ndarray:
    slot = (tokens & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def sketch(tokens: np.ndarray) -> bytes:
    """Bit i: whether an odd number of tokens fall on i, of as many bits as tokens (a power of
    two within ``SKETCH_BITS``). A longer one folds to a shorter: its halves combine by xor."""
    bits = SKETCH_BITS[0]
    while bits < min(len(tokens), SKETCH_BITS[1]):
        bits *= 2
    odd = np.bincount((_mix(tokens) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


class Sketches:
    """Sketches of many sets, folded to every length that they have or exceed."""

    def __init__(self, column):
        raw = column.to_pylist()
        self.words = np.array([len(x) >> 3 for x in raw], np.int64)
        self.at, self.row, rows, longer = {}, {}, np.zeros(0, np.int64), None
        size = SKETCH_BITS[1] >> 6
        while size >= SKETCH_BITS[0] >> 6:
            own = np.flatnonzero(self.words == size)
            m = np.frombuffer(b"".join([raw[i] for i in own.tolist()]), np.uint64).reshape(-1, size)
            if longer is not None:
                m = np.concatenate([longer[:, :size] ^ longer[:, size:], m])
            rows = np.concatenate([rows, own])
            self.at[size], self.row[size] = m, np.full(len(raw), -1, np.int64)
            self.row[size][rows] = np.arange(len(rows))
            longer, size = m, size // 2

    def apart(self, i: np.ndarray, other: Sketches, j: np.ndarray) -> np.ndarray:
        """Distances of the sketches i of these and j of the others, at the shorter's length."""
        size, out = np.minimum(self.words[i], other.words[j]), np.zeros(len(i), np.int64)
        for w in np.unique(size).tolist():
            pairs = np.flatnonzero(size == w)
            step = max(1, (1 << 22) // w)
            for lo in range(0, len(pairs), step):
                k = pairs[lo:lo + step]
                x = self.at[w][self.row[w][i[k]]] ^ other.at[w][other.row[w][j[k]]]
                out[k] = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
        return out


def _texts(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, STEP):
            b = whole.slice(at, STEP)
            yield b, b.column(b.num_columns - 1).to_pylist()


def _head_rows(n: int, percent: int):
    def rows(batches):
        for _, texts in _texts(batches):
            heads = [head(token_set(t, n), percent) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(heads).view(np.int64))], ["token"])
    return rows


_SET = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("sigs", pa.list_(pa.int64())),
                  ("sketch", pa.binary()), ("tokens", pa.binary())])


def _set_rows(n: int, percent: int, shared):
    """A row per document; signatures, sketch and tokens where it may link."""
    def rows(batches):
        shared_bits, frequent_bits = shared.value
        for b, texts in _texts(batches):
            out = []
            for doc, t in zip(b.column(0).to_pylist(), texts, strict=True):
                s = token_set(t, n)
                fp = xxh3_128_digest(s.tobytes()) if len(s) else None
                sigs = signatures(s, shared_bits, frequent_bits, percent) if len(s) else None
                may = sigs is not None
                out.append((doc, len(s), fp, sigs, sketch(s) if may else None, s.tobytes() if may else None))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SET, strict=True)], schema=_SET)
    return rows


def _near_sketch(percent: int):
    def rows(batches):
        for b in batches:
            each = np.arange(b.num_rows)
            ok = _near(np.asarray(b.column("na"), np.int64), Sketches(b.column("xa")), each,
                       np.asarray(b.column("nb"), np.int64), Sketches(b.column("xb")), each, percent)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))
    return rows


def _near(n, x: Sketches, i, m, y: Sketches, j, percent: int) -> np.ndarray:
    """Whether sizes (n of i, m of j) and sketches allow a link."""
    total = n[i] + m[j]
    least = -(-percent * total // (100 + percent))  # the smallest intersection that links
    ok = np.minimum(n[i], m[j]) >= least
    at = np.flatnonzero(ok)
    ok[at] = x.apart(i[at], y, j[at]) <= (total - 2 * least)[at]
    return ok


def _spanning(run: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Indexes of pairs (a, b) that join components within each run, as in a forest."""
    order = np.unique(np.stack([run, np.minimum(a, b), np.maximum(a, b)]), axis=1, return_index=True)[1]
    kept, now, up = [], -1, {}
    for k in order.tolist():
        if run[k] != now:
            now, up = run[k], {}
        x, y = int(a[k]), int(b[k])
        while up.get(x, x) != x:
            x = up[x]
        while up.get(y, y) != y:
            y = up[y]
        if x != y:
            up[x] = y
            kept.append(k)
    return kept


def _cross_pairs(percent: int, forest: bool):
    """Near pairs of different components within each run of equal (sig, i, j), all or as
    many as would join the components; rows come sorted by (sig, i, j). Of blocks i and j
    only pairs across are compared. A pair with a signature below sig among both sets' lowest
    is left to that one's run: there, both have the same roots and meet as well."""
    def pairs(t: pa.Table):
        key = np.arange(t.num_rows)
        change = np.ones(t.num_rows, bool)
        for c in ("sig", "i", "j"):
            v = np.asarray(t[c])
            change[1:] &= v[1:] == v[:-1]
        change[0] = False
        start = np.flatnonzero(~change)
        size = np.diff(np.append(start, t.num_rows))
        follow = np.repeat(start + size, size) - key - 1  # rows after this one in its run
        run = np.cumsum(~change)
        n, side, across = (np.asarray(t[c], np.int64) for c in ("n", "side", "across"))
        root = t["root"].combine_chunks().dictionary_encode().indices.to_numpy()
        sketches = Sketches(t["sketch"])
        sig, low, below = np.asarray(t["sig"]), t["low"].combine_chunks(), {}
        ends, lo = np.cumsum(follow), 0

        def lower(k):
            if k not in below:
                below[k] = {x for x in low[k].as_py() if x < sig[k]}
            return below[k]

        while lo < t.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
            left = np.repeat(np.arange(lo, hi), follow[lo:hi])
            right = left + 1 + np.arange(len(left)) - np.repeat(ends[lo:hi] - follow[lo:hi] - base, follow[lo:hi])
            ok = (root[left] != root[right]) & ((across[left] == 0) | (side[left] != side[right]))
            left, right = left[ok], right[ok]
            ok = _near(n, sketches, left, n, sketches, right, percent)
            left, right = left[ok], right[ok]
            first = np.fromiter((lower(x).isdisjoint(lower(y)) for x, y in zip(left.tolist(), right.tolist(), strict=True)),
                                bool, len(left))
            if first.any():
                left, right = left[first], right[first]
                if forest:
                    few = _spanning(run[left], root[left], root[right])
                    left, right = left[few], right[few]
                a, b = (t["fp"].take(pa.array(x)).to_pylist() for x in (left, right))
                both = {(x, y) if x < y else (y, x) for x, y in zip(a, b, strict=True)}
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in both], pa.binary()),
                                                  pa.array([y for _, y in both], pa.binary())], ["a", "b"])
            lo = hi

    def rows(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            last = np.ones(t.num_rows, bool)
            for c in ("sig", "i", "j"):
                v = np.asarray(t[c])
                last &= v == v[-1]
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut:
                yield from pairs(t.slice(0, cut).combine_chunks())
            held = t.slice(cut)
        if held is not None and held.num_rows:
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


def _bits(tokens: DataFrame) -> np.ndarray:
    """Packed bitmap of the tokens' slots, built by the executors in pieces of 4 kB."""
    slot = F.col("token").bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1  # the SQL functions count from 1
    rows = tokens.groupBy(F.bitmap_bucket_number(slot).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(BITMAP_BITS >> 3, np.uint8)
    for r in rows:  # BITMAP_BITS / 2^15 at most
        out[(r["b"] - 1) << 12:r["b"] << 12] = np.frombuffer(r["bits"], np.uint8)
    return out


def components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = written(docs.select("text").mapInArrow(_head_rows(n, percent), "token long")
                     .groupBy("token").count().where("count > 1"), "tokens")
    bits = spark.sparkContext.broadcast((_bits(counts), _bits(counts.where(F.col("count") > FREQUENT))))
    sets = written(docs.mapInArrow(_set_rows(n, percent, bits), "doc_id long, n long, fp binary, sigs array<long>, "
                                   "sketch binary, tokens binary"), "sets")
    bits.destroy()  # the sets are written
    classes = written(sets.where("sigs IS NOT NULL").select("fp", "n", "sigs", "sketch", "tokens")
                      .dropDuplicates(["fp"]), "classes")
    tokens = classes.select("fp", "tokens")
    sigs = classes.select("fp", F.explode("sigs").alias("sig"))
    several = sigs.groupBy("sig").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("sig")
    groups = written(sigs.join(several, "sig"), "groups")  # signatures of two classes or more

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = (classes.select(F.col("fp").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"x{x}"))
                for x in ("a", "b"))
        near = pairs.join(a, "a").join(b, "b").mapInArrow(_near_sketch(percent), "a binary, b binary")
        a, b = (tokens.select(F.col("fp").alias(x), F.col("tokens").alias(f"t{x}")) for x in ("a", "b"))
        return near.join(a, "a").join(b, "b").mapInArrow(_linked(percent), "a binary, b binary")

    def pair(x, y):
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    def cross(members: DataFrame, forest: bool) -> DataFrame:
        """Pairs of different components, a group in blocks of about ``BLOCK`` members:
        every two blocks meet in one place, so a large group is spread over many tasks."""
        sizes = members.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k"))
        # a set's signatures: bounded by its tokens
        held = members.join(sizes, "sig").groupBy("fp", "root").agg(F.sort_array(F.collect_list(F.struct("sig", "k"))).alias("sigs"))
        rows = held.withColumn("low", F.slice("sigs", F.lit(1), F.lit(LOW))["sig"]).join(
            classes.select("fp", "n", "sketch"), "fp").select("fp", "root", "n", "sketch", "low", F.inline("sigs")).withColumn(
            "own", F.pmod(F.xxhash64("fp"), "k").cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        rows = rows.select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                           (F.col("own") > F.col("other")).cast("int").alias("side"),
                           (F.col("own") != F.col("other")).cast("int").alias("across"), "fp", "n", "root", "sketch",
                           F.filter("low", lambda x: x < F.col("sig")).alias("low"))
        return rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInArrow(
            _cross_pairs(percent, forest), "a binary, b binary")

    links, roots, open_ = None, None, groups
    for step in ("pivots", "forest", "all"):
        if step == "pivots":
            chosen = F.xxhash64("fp", F.pmod("sig", F.lit(PIVOT_KINDS)))
            pivots = open_.groupBy("sig").agg(F.min_by("fp", F.struct(chosen, "fp")).alias("p"))
            pairs = open_.join(pivots, "sig").where("fp != p").select(*pair(F.col("fp"), F.col("p")))
        else:
            pairs = cross(open_, step == "forest")
        found = written(verified(pairs.distinct()), "links")
        links = found if links is None else links.union(found)
        roots = connected(links)
        if step == "all":
            break
        rooted = groups.join(roots.select(F.col("v").alias("fp"), "root"), "fp", "left").withColumn(
            "root", F.coalesce("root", "fp"))
        still = rooted.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        open_ = written(rooted.join(still.select("sig"), "sig"), "open")
        if open_.isEmpty():
            break

    firsts = sets.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("first"))
    firsts = written(firsts.join(roots.select(F.col("v").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")), "firsts")
    named = firsts.join(firsts.groupBy("root").agg(F.min("first").alias("component_id")), "root").select(
        "fp", "component_id")
    full = sets.where("n > 0").select("doc_id", "n", "fp").join(named, "fp").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"),
                                                      F.col("doc_id").alias("component_id")))


def representatives(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The document with the smallest doc_id of each group, columns unchanged; documents
    with a null doc_id or without words are in no group and stay. Of rows that repeat a
    doc_id whose group it names, all stay: they are one document."""
    key = free_name(docs, "_kept")
    kept = components(docs, n, percent).where(
        "n_shingles = 0 OR doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(kept, F.col("doc_id") == F.col(key), "left_semi").unionByName(docs.where("doc_id IS NULL"))
