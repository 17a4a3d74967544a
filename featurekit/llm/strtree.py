"""Hard negatives by an R-tree packed by sorting (sort-tile-recursive).

Rows are labelled integer vectors; an anchor's score of a row is their inner product. An
anchor's positives are its best rows of the same label; the hard negatives of (anchor, positive) are the best
rows of another label whose score lies in a window below the positive's.

Packing. The first two sort coordinates, the label and the vector's coordinate of the greatest variance, cut all
rows into tiles of at most ``TILE`` rows (a range partitioning, ties parted by a hash of the id, then slices
of the sorted partition). Inside a tile the remaining coordinates are sorted and cut in turn, those of the
greatest variance first, down to leaves of ``LEAF`` rows; ``FANOUT`` neighbours make a node of the next
level. Every node has its minimum bounding box, the label's range included.

Search. Per coordinate, a box bounds the product with the anchor's component from both sides; the sums bound the
inner product of every row inside. Per anchor, a queue takes the node with the highest upper bound first. A
node is left out if its labels cannot do, if its interval lies outside every window still open, or
strictly below the kth best of each (an equal score may still have a smaller id). A tile that holds an anchor gives it
a first lower bound for its positives.

Spread. Anchors are packed into blocks, and blocks meet tiles by (tile, chunk of blocks): a task holds one tile and
``CHUNK_BLOCKS`` blocks at most, whatever the tables' sizes. A pair of tile and block whose labels exclude each
other is not formed. Every tile gives its best k rows per window, and the best k of those are the result: the
stated query set against all rows, with no cap and no sample.

Products are exact: in doubles where no sum can reach 2^53, otherwise in Python's integers. Scores have
to fit a long.

Defined results: rows with a null id, a null label, a null vector or a null or non-finite component take no part; of rows
that repeat an id, the least (label, vector) does; vectors of different lengths are multiplied over their common
coordinates; ties go to the smaller id; an anchor without positives, or a positive without negatives in
its window, has no rows; an empty table gives no rows; other columns are left aside.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featurekit.llm.common import written
from featurekit.session import ship_package

TILE, LEAF, FANOUT = 8192, 64, 8
#: Anchors of a block, blocks that meet a tile in one task, and blocks at least (so that small tables spread too).
BLOCK, CHUNK_BLOCKS, LEAST_BLOCKS = 256, 64, 8
_EXACT = float(1 << 53)


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, one of each id."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("vector").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector")


# ------------------------------------------------------------------ packing
def _order(matrix: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The rows in the order of their leaves; leaf i holds rows i * ``LEAF`` on."""
    columns = [labels, *matrix.T[np.argsort(-matrix.var(axis=0), kind="stable")]] if len(matrix) else [labels]

    def cut(rows: np.ndarray, at: int) -> list[np.ndarray]:
        pages = -(-len(rows) // LEAF)
        if pages <= 1:
            return [rows]
        left = len(columns) - at
        rows = rows[np.argsort(columns[at][rows], kind="stable")]
        if left == 1:
            return [rows]
        slabs = max(2, round(pages ** (1 / left)))
        size = LEAF * -(-pages // slabs)
        return [x for lo in range(0, len(rows), size) for x in cut(rows[lo:lo + size], at + 1)]
    one = labels.min() == labels.max()
    return np.concatenate(cut(np.arange(len(labels)), 1 if one and len(columns) > 1 else 0))


def _levels(matrix: np.ndarray, labels: np.ndarray):
    """Boxes (lo, hi, first label, last label) of each level of nodes, the leaves first."""
    def merged(lo, hi, first, last, by):
        at = np.arange(0, len(lo), by)
        return (np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.minimum.reduceat(first, at),
                np.maximum.reduceat(last, at))
    levels = [merged(matrix, matrix, labels, labels, LEAF)]
    while len(levels[-1][0]) > 1:
        levels.append(merged(*levels[-1], FANOUT))
    return levels


def _small(x: np.ndarray) -> np.ndarray:
    """The integers in the narrowest type that holds them exactly."""
    top = np.abs(x).max(initial=0)
    return x.astype(np.int8 if top < 128 else np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.float64)


def _matrix(vectors: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of each vector, shorter ones filled up with zeros (which add nothing)."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None] < sizes[:, None]] = flat
    return out


_TILE = pa.schema([("tile", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()),
                   ("matrix", pa.binary()), ("kind", pa.string())])
TILE_ROW = "tile long, first long, last long, ids binary, labels binary, matrix binary, kind string"


def _tiles(scale: float, tile_rows: int):
    def tile(number, t):
        ids, labels = np.asarray(t["vec_id"], np.int64), np.asarray(t["label"], np.int64)
        matrix = _matrix(t["vector"].combine_chunks(), scale)
        order = _order(matrix, labels)
        kept = _small(matrix[order])
        return pa.RecordBatch.from_pylist([{
            "tile": number, "first": int(labels.min()), "last": int(labels.max()), "ids": ids[order].tobytes(),
            "labels": labels[order].tobytes(), "matrix": kept.tobytes(), "kind": kept.dtype.str}], schema=_TILE)

    def rows(batches):
        number, held, n = TaskContext.get().partitionId() << 33, [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            while n >= tile_rows:
                t = pa.Table.from_batches(held)
                yield tile(number, t.slice(0, tile_rows))
                held, n, number = t.slice(tile_rows).to_batches(), n - tile_rows, number + 1
        if n:
            yield tile(number, pa.Table.from_batches(held))
    return rows


def pack(rows: DataFrame, scale: float = 256, tile_rows: int = TILE) -> DataFrame:
    """The index of ``rows`` (of ``usable``): its tiles (``TILE_ROW``), written."""
    ship_package(rows.sparkSession)
    spread = rows.select(F.posexplode("vector").alias("c", "x")).groupBy("c").agg(F.var_pop("x").alias("v"))
    first = spread.orderBy(F.desc("v"), "c").first()  # a row per coordinate
    lead = F.coalesce(F.get("vector", F.lit(first["c"] if first else 0)), F.lit(0.0))
    keys = ["label", lead.alias("lead"), F.xxhash64("vec_id").alias("tie")]
    rows = rows.select(*keys, "vec_id", "vector").repartitionByRange("label", "lead", "tie").sortWithinPartitions(
        "label", "lead", "tie")
    return written(rows.mapInArrow(_tiles(scale, tile_rows), TILE_ROW), "tiles")


class Tile:
    """A tile's tree."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.matrix = np.frombuffer(row["matrix"], row["kind"]).astype(np.float64).reshape(len(self.ids), -1)
        self.top = np.abs(self.matrix).max(initial=0)
        self.levels = _levels(self.matrix, self.labels)

    def bounds(self, anchors: np.ndarray):
        """Lower and upper bounds of the inner products, of each level: (anchors, nodes)."""
        plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(plus @ lo.T + minus @ hi.T, plus @ hi.T + minus @ lo.T) for lo, hi, _, _ in self.levels]

    def search(self, anchors: np.ndarray, ids, labels, windows, same: bool, k: int):
        """Of each anchor and window (lowest, highest score; None: open): the k best (scores, ids)."""
        d = min(anchors.shape[1], self.matrix.shape[1])
        anchors, tree = anchors[:, :d], self
        if d < self.matrix.shape[1] or self.top * np.abs(anchors).max(initial=0) * max(1, d) >= _EXACT:
            tree = Tile.__new__(Tile)
            tree.ids, tree.labels, tree.matrix = self.ids, self.labels, self.matrix[:, :d]
            if self.top * np.abs(anchors).max(initial=0) * max(1, d) >= _EXACT:
                tree.matrix, anchors = (np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape)
                                        for x in (tree.matrix, anchors))
            tree.levels = _levels(tree.matrix, tree.labels)
        bounds = tree.bounds(anchors)
        return [tree._best(anchors[i], [(lo[i].tolist(), hi[i].tolist()) for lo, hi in bounds], int(ids[i]), int(labels[i]),
                           windows[i], same, k) for i in range(len(anchors))]

    def _best(self, anchor, bounds, own, label, windows, same, k):
        found = [([], []) for _ in windows]  # scores descending, ids
        least = [float("-inf") if lo is None else lo for lo, _ in windows]  # kth best score once there are k
        most = [float("inf") if hi is None else hi for _, hi in windows]

        def open_(level, node):
            lo, hi = bounds[level][0][node], bounds[level][1][node]
            first, last = self.levels[level][2][node], self.levels[level][3][node]
            if not first <= label <= last if same else first == last == label:
                return False
            return any(lo <= m and min(hi, m) >= x for x, m in zip(least, most, strict=True))

        top = len(self.levels) - 1
        queue = [(-bounds[top][1][0], top, 0)] if open_(top, 0) else []
        while queue:
            upper, level, node = heapq.heappop(queue)
            if -upper < min(least):
                break
            if not open_(level, node):  # the kth best may have risen
                continue
            if level:
                for child in range(node * FANOUT, min(node * FANOUT + FANOUT, len(bounds[level - 1][0]))):
                    if open_(level - 1, child):
                        heapq.heappush(queue, (-bounds[level - 1][1][child], level - 1, child))
                continue
            rows = slice(node * LEAF, node * LEAF + LEAF)
            scores, ids, labels = self.matrix[rows] @ anchor, self.ids[rows], self.labels[rows]
            fit = (labels == label) & (ids != own) if same else labels != label
            for w, (x, m) in enumerate(zip(least, most, strict=True)):
                at = np.flatnonzero(fit & (scores >= x) & (scores <= m))
                if len(at):
                    s, i = found[w]
                    best = sorted(zip([*s, *scores[at].tolist()], [*i, *ids[at].tolist()], strict=True),
                                  key=lambda r: (-r[0], r[1]))[:k]
                    found[w] = [r[0] for r in best], [r[1] for r in best]
                    if len(best) == k:
                        least[w] = best[-1][0]
        return found


# ------------------------------------------------------------------- search
_ANCHOR = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.float64())),
                     ("slots", pa.list_(pa.int64())), ("lows", pa.list_(pa.int64())), ("highs", pa.list_(pa.int64()))])
ANCHOR = "vec_id long, label long, vector array<double>, slots array<long>, lows array<long>, highs array<long>"


def _anchors(every: int, k: int):
    """The anchors among a tile's rows; their window starts at their kth best score in that tile."""
    def rows(batches):
        for b in batches:
            for r in b.to_pylist():
                t = Tile(r)
                at = np.flatnonzero(t.ids % every == 0)
                if not len(at):
                    continue
                got = t.search(t.matrix[at], t.ids[at], t.labels[at], [[(None, None)]] * len(at), True, k)
                lows = [[int(s[-1]) if len(s) == k else None] for ((s, _),) in got]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(
                    [t.ids[at], t.labels[at], list(t.matrix[at]), [[0]] * len(at), lows, [[None]] * len(at)],
                    _ANCHOR, strict=True)], schema=_ANCHOR)
    return rows


_BLOCKED = pa.schema([("block", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("anchors", pa.binary())])


def _blocks(batches):
    """Anchors packed into blocks: an Arrow table each."""
    number, held, n = TaskContext.get().partitionId() << 33, [], 0

    def block(t):
        labels, sink = np.asarray(t["label"], np.int64), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _ANCHOR) as out:
            out.write_table(t)
        return pa.RecordBatch.from_pylist([{"block": number, "first": int(labels.min()), "last": int(labels.max()),
                                            "anchors": sink.getvalue().to_pybytes()}], schema=_BLOCKED)
    for b in batches:
        held.append(b)
        n += b.num_rows
        while n >= BLOCK:
            t = pa.Table.from_batches(held).cast(_ANCHOR)
            yield block(t.slice(0, BLOCK).combine_chunks())
            held, n, number = t.slice(BLOCK).to_batches(), n - BLOCK, number + 1
    if n:
        yield block(pa.Table.from_batches(held).cast(_ANCHOR).combine_chunks())


_FOUND = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])


def _searched(same: bool, k: int):
    def rows(tiles: pa.Table, blocks: pa.Table):
        out = [[], [], [], []]
        for row in tiles.to_pylist():  # one
            tree = Tile(row)
            for raw in blocks["anchors"]:
                t = pa.ipc.open_stream(raw.as_buffer()).read_all().combine_chunks()
                anchors = _matrix(t["vector"].combine_chunks(), 1)
                ids, slots = t["vec_id"].to_pylist(), t["slots"].to_pylist()
                windows = [list(zip(lo, hi, strict=True)) for lo, hi in zip(
                    t["lows"].to_pylist(), t["highs"].to_pylist(), strict=True)]
                got = tree.search(anchors, ids, t["label"].to_pylist(), windows, same, k)
                for a, s, best in zip(ids, slots, got, strict=True):
                    for slot, (scores, found) in zip(s, best, strict=True):
                        out[0] += [a] * len(found)
                        out[1] += [slot] * len(found)
                        out[2] += map(int, scores)
                        out[3] += found
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(out, _FOUND, strict=True)], schema=_FOUND)
    return rows


def search(tiles: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor_id, slot, rank, vec_id, score): of each anchor (``ANCHOR``) and each of its windows (slots, lowest
    and highest scores; null: open), the k best rows of the same label or of other labels."""
    n_blocks = max(LEAST_BLOCKS, -(-anchors.count() // BLOCK))
    chunks = -(-n_blocks // CHUNK_BLOCKS)
    blocks = written(anchors.repartitionByRange(n_blocks, "label", "vec_id").sortWithinPartitions("label", "vec_id").mapInArrow(
        _blocks, "block long, first long, last long, anchors binary"), "anchor-blocks")
    dealt = blocks.withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int"))
    places = tiles.select("tile", "first", "last").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    b, t = dealt.alias("b"), places.alias("t")
    fits = (F.col("b.first") <= F.col("t.last")) & (F.col("t.first") <= F.col("b.last")) if same else ~(
        (F.col("b.first") == F.col("b.last")) & (F.col("t.first") == F.col("t.last")) & (F.col("b.first") == F.col("t.first")))
    met = b.join(t, F.col("b.chunk") == F.col("t.chunk")).where(fits).select(F.col("t.tile").alias("at"), F.col("t.chunk").alias("part"), "b.anchors")
    held = tiles.join(met.select("at", "part").distinct(), F.col("tile") == F.col("at")).select(
        "tile", F.col("part").alias("chunk"), "ids", "labels", "matrix", "kind")
    found = held.groupBy("tile", "chunk").cogroup(met.groupBy("at", "part")).applyInArrow(
        _searched(same, k), "anchor_id long, slot long, score long, vec_id long")
    w = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30,
                   high: int = 90, scale: float = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors, the rows
    (vec_id, label, vector) whose id ``every`` divides: for each of the first ``n_positives`` others of its label, the first
    ``n_negatives`` of other labels that score from ``low`` to ``high`` percent of the positive."""
    tiles = pack(usable(rows), scale)
    anchors = written(tiles.mapInArrow(_anchors(every, n_positives), ANCHOR), "anchors")
    positives = written(search(tiles, anchors, True, n_positives), "positives")
    window = positives.where(F.col("score") >= 0)  # below, the window is empty
    window = window.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
    anchors = anchors.select("vec_id", "label", "vector").join(window, F.col("vec_id") == F.col("anchor_id")).select(
        "vec_id", "label", "vector", F.col("p.vec_id").alias("slots"),
        F.transform("p.score", lambda s: F.ceil(s.cast("decimal(20,0)") * low / 100).cast("long")).alias("lows"),
        F.transform("p.score", lambda s: F.floor(s.cast("decimal(20,0)") * high / 100).cast("long")).alias("highs"))
    found = search(tiles, written(anchors, "windows"), False, n_negatives)
    scores = positives.select("anchor_id", F.col("vec_id").alias("slot"), F.col("score").alias("positive_score"))
    return found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(
        scores, ["anchor_id", "slot"]).select("anchor_id", F.col("slot").alias("positive_id"), "rank", "negative_id",
                                              "positive_score", "negative_score")
