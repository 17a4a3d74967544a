"""Token ids as a static range asymmetric numeral system (rANS).

The documents are dealt to ranges of doc_id, tokenised in order and written once as
plain ids, in blocks of whole documents. All ids are counted; the counts, one row per
id of the vocabulary, are scaled to one frequency table that sums to 2^20 and is shared by
all blocks. Then every block is encoded, independently of the others: id i of a block belongs to
lane i mod ``LANES``, every lane has a 64-bit state, and a step codes one id of all
lanes at once; lanes that overflow emit 32-bit words in lane order.

File format: a folder of two Parquet tables. ``frequencies``: (id, count, freq). ``blocks``:
part and block (their order is that of the ids), doc_ids and lengths of the documents
held, n_ids, words (the stream, little-endian), checkpoints (every ``CHECK_STEPS`` steps
the lanes' states before the step and the number of words read by then, so that a
block can be decoded from there, in parallel), and crc32 of the ids as little-endian unsigned
32-bit integers. Reading checks that crc and raises on a mismatch.

Tokenising: a batch of texts is cut where the pre-tokeniser cuts as well, the distinct
stretches that a bounded cache does not know go to the tokeniser together, and every text
is gathered from the ids of its stretches. A text with two blanks in a row, or with the
special token in it, goes to the tokeniser whole. The ids are those of the whole text.

Defined results: null texts are empty and have the end id alone; documents are ordered
by doc_id (nulls first), equal ids by text; equal rows are coded one by one; an empty
table gives an empty file; other columns are left aside.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.session import ship_package

LANES = 2048
BLOCK_IDS = 1 << 19
CHECK_STEPS = 128
SCALE_BITS = 20
END_ID = 2
#: Stretches a worker remembers before it starts anew.
CACHE = 900_000
#: Texts cut at a time, and gathered at a time.
STEP, ROWS = 5000, 32
#: Blocks (rows of 24 bytes) whose starts are broadcast to the readers; beyond it they are joined.
BROADCAST_BLOCKS = 1_000_000
#: Text per range, in bytes.
PART_BYTES = 16 << 20
_LOW = np.uint64(32)
_SCALE = np.uint64(SCALE_BITS)

BLOCKS = ("part int, block int, doc_ids array<long>, lengths array<long>, n_ids long, words binary, "
          "checkpoints array<struct<step:long, read:long, states:binary>>, crc32 long")


#: Where a text is cut: before a blank, between a letter and punctuation, and around a
#: single line feed between visible characters. The byte-level pre-tokeniser cuts there
#: too, so a stretch between cuts has the same ids alone as in its text.
_CUT = "\x01"
_PUNCTUATION = r"([\pL])([!-&(-/:-@\[-`{-~])"
_LINE = r"([!-~\pL])\n([!-~\pL])"


class Encoder:
    """Ids of whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()  # byte-level: a character of a token is a byte of text
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        self.n_bytes[list(vocab.values())] = [len(token) for token in vocab]
        for i, t in self.tokenizer.get_added_tokens_decoder().items():
            self.n_bytes[i] = len(t.content.encode())
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}  # stretch to its place in ``flat``: start * 2^16 + length
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0

    def learn(self, new: list[str]) -> None:
        # all in one sequence, without offsets: the stretches' bytes tell where each ends
        ids = np.array(self.tokenizer.encode_batch_fast([new], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        size = pc.binary_length(pa.array(new, pa.string())).to_numpy(zero_copy_only=False)
        upto = np.cumsum(size, dtype=np.int64)
        read = np.cumsum(self.n_bytes[ids])
        if read[-1] != upto[-1]:
            raise ValueError("the tokens' bytes are not the texts': not a byte-level vocabulary")
        ends = np.searchsorted(read, upto, "left") + 1
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used:self.used + len(ids)] = ids
        start = np.concatenate([[0], ends[:-1]])
        self.at.update(zip(new, (((start + self.used) << 16) | (ends - start)).tolist(), strict=True))
        self.used += len(ids)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def batch(self, texts: pa.Array):
        """Ids of each text of a batch."""
        if len(self.at) > CACHE:
            self.forget()
        odd = np.zeros(len(texts), bool)  # these go to the tokeniser whole
        for s in [*self.special, _CUT, "  "]:
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        cut = pc.replace_substring(texts, " ", f"{_CUT} ")
        cut = pc.replace_substring_regex(cut, _PUNCTUATION, f"\\1{_CUT}\\2")
        cut = pc.replace_substring_regex(cut, _LINE, f"\\1{_CUT}\n{_CUT}\\2")
        cut = pc.split_pattern(cut, _CUT)
        coded = cut.flatten().dictionary_encode()
        ends, every = cut.offsets.to_numpy(), coded.indices.to_numpy()
        parts = coded.dictionary.to_pylist()  # each stretch of the batch once
        at = self.at
        self.learn_all([p for p in parts if p not in at])
        place = np.fromiter(map(at.__getitem__, parts), np.int64, len(parts))
        start, length = place >> 16, place & 0xFFFF
        for first in range(0, len(texts), ROWS):
            edge = ends[first:first + ROWS + 1]
            part = every[edge[0]:edge[-1]]
            n = length[part]
            whole = odd[first:first + ROWS]
            if (n == 0xFFFF).any():
                whole = whole | np.array([(length[every[a:b]] == 0xFFFF).any() for a, b in zip(edge, edge[1:], strict=False)])
                n = np.where(n == 0xFFFF, 0, n)
            last = np.cumsum(n)
            ids = self.flat[np.repeat(start[part] - last + n, n) + np.arange(last[-1])]
            cut = np.concatenate([[0], last])[edge - edge[0]].tolist()
            for row, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                yield self.whole(texts[first + row].as_py()) if whole[row] else ids[a:b]

    def learn_all(self, new: list[str]) -> None:
        """Learns stretches; one of 2^16 ids or more is marked, its texts go whole."""
        long = [p for p in new if len(p) >= 1 << 14]
        for p in long:
            self.at[p] = 0xFFFF
        short = [p for p in new if len(p) < 1 << 14 and p]
        self.at[""] = 0
        for i in range(0, len(short), 1 << 14):
            self.learn(short[i:i + (1 << 14)])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2^SCALE_BITS, at least 1 where an id occurs."""
    total = counts.sum()
    if not total:
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, counts * (1 << SCALE_BITS) // total), 0).astype(np.int64)
    over = int(freq.sum()) - (1 << SCALE_BITS)
    for i in np.argsort(-freq, kind="stable"):  # the largest give or take the difference
        change = -over if over < 0 else -min(over, int(freq[i]) // 2)
        freq[i] += change
        over += change
        if not over:
            break
    return freq


class Tables:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.limit = self.freq << np.uint64(64 - SCALE_BITS)  # a state from here on emits first
        self.one = self.freq == np.uint64(1 << SCALE_BITS)  # its limit is 2^64: it never emits
        self._of = None

    @property
    def of(self) -> np.ndarray:
        """Id by slot."""
        if self._of is None:
            self._of = np.repeat(np.arange(len(self.freq)), self.freq.astype(np.int64)).astype(np.uint32)
        return self._of


def encode(ids: np.ndarray, t: Tables) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray]]]:
    """(words, checkpoints) of a block."""
    n_steps = -(-len(ids) // LANES)
    x = np.full(LANES, 1 << 32, np.uint64)
    out, kept, emitted = [], [], 0
    for step in range(n_steps - 1, -1, -1):
        s = ids[step * LANES:(step + 1) * LANES]
        lane = x[:len(s)]
        full = (lane >= t.limit[s]) & ~t.one[s]
        if full.any():
            words = (lane[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            out.append(words)
            emitted += len(words)
            lane[full] >>= _LOW
        f = t.freq[s]
        q = lane // f
        x[:len(s)] = (q << _SCALE) + (lane - q * f) + t.start[s]
        if step % CHECK_STEPS == 0:
            kept.append((step, emitted, x.copy()))
    words = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
    return words, [(step, emitted - left, states) for step, left, states in reversed(kept)]


def decode(words: np.ndarray, checkpoint: tuple[int, int, np.ndarray], n_ids: int, t: Tables,
           steps: int | None = None) -> np.ndarray:
    """Ids from a checkpoint on, of ``steps`` steps or to the block's end."""
    first, at, states = checkpoint
    x = np.array(states, np.uint64)
    last = -(-n_ids // LANES) if steps is None else min(first + steps, -(-n_ids // LANES))
    mask, of, freq, start = np.uint64((1 << SCALE_BITS) - 1), t.of, t.freq, t.start
    out = np.zeros(max(0, min(n_ids, last * LANES) - first * LANES), np.uint32)
    for step in range(first, last):
        n = min(LANES, n_ids - step * LANES)
        lane = x[:n]
        slot = lane & mask
        s = of[slot]
        out[(step - first) * LANES:(step - first) * LANES + n] = s
        lane = freq[s] * (lane >> _SCALE) + slot - start[s]
        low = np.flatnonzero(lane < np.uint64(1 << 32))
        if len(low):
            lane[low] = (lane[low] << _LOW) | words[at:at + len(low)].astype(np.uint64)
            at += len(low)
        x[:n] = lane
    return out


PLAIN = "part int, block int, doc_ids array<long>, lengths array<long>, n_ids long, planes binary"
_PLAIN_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("n_ids", pa.int64()), ("planes", pa.binary())])


def _tokeniser(path: str):
    def rows(batches):
        enc = _encoder(path)
        part, end = TaskContext.get().partitionId(), np.array([END_ID], np.uint32)
        block, docs, parts, size = 0, [], [], 0
        total = np.zeros(0, np.int64)

        def made():
            nonlocal total
            # byte by byte of the ids, which compresses better
            ids = np.concatenate([x for p in parts for x in (p, end)]).astype("<u4")
            planes = ids.view(np.uint8).reshape(-1, 4).T.tobytes()
            got = np.bincount(ids)
            if len(got) > len(total):
                total, got = got, total
            total[:len(got)] += got
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "doc_ids": docs, "lengths": [len(p) + 1 for p in parts],
                "n_ids": len(planes) // 4, "planes": planes}], schema=_PLAIN_ARROW)

        for b in (whole.slice(at, STEP) for whole in batches for at in range(0, whole.num_rows, STEP)):
            for doc, ids in zip(b.column(0).to_pylist(), enc.batch(b.column(1)), strict=True):
                parts.append(ids)
                docs.append(doc)
                size += len(ids) + 1
                if size >= BLOCK_IDS:
                    yield made()
                    block, docs, parts, size = block + 1, [], [], 0
        if docs:
            yield made()
        at = np.flatnonzero(total)
        if len(at):  # the counts of the range: ids and how often, in the row of block -1
            yield pa.RecordBatch.from_pylist([{
                "part": part, "block": -1, "doc_ids": at.tolist(), "lengths": total[at].tolist(), "n_ids": 0,
                "planes": b""}], schema=_PLAIN_ARROW)
    return rows


def _ids(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _block_encoder(shared):
    def rows(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = _ids(r.pop("planes"))
                words, checkpoints = encode(ids, shared.value)
                yield pa.RecordBatch.from_pylist([r | {
                    "words": words.tobytes(), "crc32": zlib.crc32(ids.tobytes()),
                    "checkpoints": [{"step": s, "read": n, "states": x.astype("<u8").tobytes()}
                                    for s, n, x in checkpoints]}], schema=_BLOCK_ARROW)
    return rows


_BLOCK_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("n_ids", pa.int64()), ("words", pa.binary()),
    ("checkpoints", pa.list_(pa.struct([("step", pa.int64()), ("read", pa.int64()), ("states", pa.binary())]))),
    ("crc32", pa.int64())])


def write(docs: DataFrame, folder: str, tokenizer_path: str) -> None:
    """Writes the ids of every text, in ascending doc_id order, to ``folder``."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n_bytes = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    plain = f"{folder}/plain"
    (docs.repartitionByRange(max(1, math.ceil(n_bytes / PART_BYTES)), F.col("doc_id").asc_nulls_first(),
                             F.xxhash64("text"))
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
     .mapInArrow(_tokeniser(tokenizer_path), PLAIN).write.option("compression", "zstd").parquet(plain))
    blocks = spark.read.schema(PLAIN).parquet(plain)
    counts = blocks.where("block < 0").select(F.explode(F.arrays_zip("doc_ids", "lengths")).alias("c"))
    rows = counts.groupBy(F.col("c.doc_ids").alias("id")).agg(
        F.sum("c.lengths").alias("count")).collect()  # one row per id of the vocabulary
    total = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        total[r["id"]] = r["count"]
    freq = scaled(total)
    spark.createDataFrame([(int(i), int(total[i]), int(freq[i])) for i in np.flatnonzero(total)],
                          "id long, count long, freq long").coalesce(1).write.parquet(f"{folder}/frequencies")
    shared = spark.sparkContext.broadcast(Tables(freq))
    blocks.where("block >= 0").mapInArrow(_block_encoder(shared), BLOCKS).write.parquet(f"{folder}/blocks")


def tables(spark: SparkSession, folder: str) -> Tables:
    rows = spark.read.parquet(f"{folder}/frequencies").collect()
    freq = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    return Tables(freq)


def _reader(shared):
    def rows(batches):
        t = shared.value
        for b in batches:
            for r in b.to_pylist():
                first = r["checkpoints"][0]
                ids = decode(np.frombuffer(r["words"], "<u4"),
                             (first["step"], first["read"], np.frombuffer(first["states"], "<u8")), r["n_ids"], t)
                raw = ids.astype("<u4").tobytes()
                if zlib.crc32(raw) != r["crc32"]:
                    raise ValueError(f"block {r['part']}/{r['block']}: checksum mismatch")
                ends = np.cumsum(r["lengths"])
                spans = [(int(e - n), n) for e, n in zip(ends, r["lengths"], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["doc_ids"], pa.int64()), pa.array([s + r["before"] for s, _ in spans], pa.int64()),
                    pa.array(r["lengths"], pa.int64()),
                    pa.array([raw[4 * s:4 * (s + n)] for s, n in spans], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])
    return rows


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) per document; ids: little-endian unsigned 32-bit."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(tables(spark, folder))
    blocks = spark.read.parquet(f"{folder}/blocks")
    # one narrow row per block: starts within a part, and of the parts
    within = blocks.select("part", "block", "n_ids", F.expr(
        "sum(n_ids) OVER (PARTITION BY part ORDER BY block) - n_ids").alias("inside"))
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.expr("sum(n) OVER (ORDER BY part) - n").alias("base"))
    starts = within.join(parts, "part").select("part", "block", (F.col("inside") + F.col("base")).alias("before"))
    if blocks.count() <= BROADCAST_BLOCKS:
        starts = F.broadcast(starts)
    return blocks.join(starts, ["part", "block"]).select(
        "part", "block", "before", "doc_ids", "lengths", "n_ids", "words",
        F.slice("checkpoints", 1, 1).alias("checkpoints"), "crc32").mapInArrow(
        _reader(shared), "doc_id long, start long, n_tokens long, ids binary")
