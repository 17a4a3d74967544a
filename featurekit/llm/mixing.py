"""Mixing sources to target weights (native).

The words of a source, document after document, form one stream that is packed into
fixed-length blocks. A source gets as many slots in the mix as its target needs; each
slot draws its output shard by a seeded hash, so a shard's counts per source are
multinomial. Slot j of pass e of a source maps to block perm(j), a keyed pseudorandom
permutation of the source's block indexes (swap-or-not: an involution per round on any
domain size, in plain arithmetic), and slots are joined with blocks by index. A pass
uses every block at most once and no target exceeds two passes, so no document is
taken more than twice. The last slot of a source is cut to the words still missing, so
the words taken equal the target to within one word.

The mix is written as a folder of blocks per output shard (``write_blocks``): inside a
shard the slots of all sources stand in hash order at positions gapless from 0, and a
block names the stretches of documents it is packed of. Words taken, mixed documents and
the blocks' texts are all derived from those files.

Targets: all sources, by code point with null last, weigh 3, 1, 2, repeating, and share
150 % of all words; a target stops at twice its source's words, the excess is shared
again by weight (water-filling, in closed form).

Defined results: null texts and texts without words have size 0 and nothing taken; a
null source is a source of its own; equal rows are packed one after the other and
counted each; an empty table gives an empty mix; further columns of the input are left
out of the plan and cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurekit.llm.common import WORD, word_count, written
from featurekit.session import fresh_dir

#: Weights by rank of the source, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
BLOCK_WORDS = 128
ROUNDS = 12
#: Documents of a source are laid out by hash bucket, so that no prefix sum needs a
#: whole source in one task: as many rows a bucket on average, and this many buckets at least.
LAYOUT_ROWS, LAYOUT_BUCKETS = 1 << 14, 1024
#: Slots made by one row of the slot generator.
SLOT_CHUNK = 1 << 14


def layout(docs: DataFrame, carry: tuple = ()) -> DataFrame:
    """(doc_id, source, size, start, *carry): each document's first word in the word
    stream of its source. Prefix sums in two steps: within (source, bucket), and over
    the buckets of a source."""
    rows = docs.select("doc_id", "source", *carry, word_count(F.col("text")).alias("size"),
                       F.xxhash64("text").alias("_th"))
    if not carry:
        rows = written(rows, "mix-sizes")  # narrow: cheaper than counting the words twice
    n_buckets = max(LAYOUT_BUCKETS, math.ceil(rows.select("source").count() / LAYOUT_ROWS))
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("doc_id", "_th"), F.lit(n_buckets)))
    totals = rows.groupBy("source", F.col("_b").alias("_b2")).agg(F.sum("size").alias("n"))
    within = Window.partitionBy("source", "_b").orderBy("doc_id", "_th")
    rows = rows.withColumn("_before", F.sum("size").over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    upto = Window.partitionBy("source").orderBy("_b2").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = totals.select(F.col("source").alias("_s2"), "_b2", (F.sum("n").over(upto) - F.col("n")).alias("_base"))
    return (rows.join(totals, F.col("source").eqNullSafe(F.col("_s2")) & (F.col("_b") == F.col("_b2")))
            .select("doc_id", "source", *carry, "size", (F.col("_base") + F.col("_before")).alias("start")))


def source_targets(laid: DataFrame) -> DataFrame:
    """(sid, source, words, target): one row per source."""
    per = laid.groupBy("source").agg(F.sum("size").alias("words"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # over the sources, one row each
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    per = per.withColumn("sid", (F.row_number().over(by_name) - 1).cast("long"))
    per = per.withColumn("w", F.get(weights, (F.col("sid") % len(WEIGHTS)).cast("int")))
    per = per.withColumn("cap", 2.0 * F.col("words")).withColumn("ratio", F.col("cap") / F.col("w"))
    # the level: each source gets min(cap, level * weight); sources below it are capped
    by_ratio = Window.orderBy("ratio", "sid")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight = F.sum("w").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("total", 1.5 * F.sum("words").over(everything))
    per = per.withColumn("level", (F.col("total") - capped) / weight)
    per = per.withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    target = F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("cap")).otherwise(
        F.col("level") * F.col("w"))
    return per.select("sid", "source", "words", target.alias("target"))


def permuted(of: Column, seed: int, inverse: bool = False) -> Column:
    """perm(of) (or its inverse) in [0, nb), keyed by the row's (sid, pass): swap-or-not
    rounds, each of which is its own inverse."""
    def swap(x: Column, r: Column) -> Column:
        key = (F.lit(seed), F.col("sid"), F.col("pass"), r)
        y = F.pmod(F.pmod(F.xxhash64(*key), F.col("nb")) - x, F.col("nb"))
        bit = F.xxhash64(*key, F.greatest(x, y)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, y).otherwise(x)

    rounds = range(ROUNDS)
    order = F.array(*[F.lit(r) for r in (reversed(rounds) if inverse else rounds)])
    return F.aggregate(order, of.cast("long"), swap)


def slots(targets: DataFrame, n_shards: int, block_words: int, seed: int) -> DataFrame:
    """(sid, pass, slot, shard, position, block, take): a row per block the mix takes. A
    shard's positions follow a hash of the slot, counted within hash cells of about
    ``SLOT_CHUNK`` slots and over the cells."""
    L = F.lit(block_words).cast("long")
    per = targets.where("words > 0").select(
        "sid", "words", F.round("target").cast("long").alias("goal"),
        F.ceil(F.col("words") / block_words).cast("long").alias("nb"))
    per = per.withColumn("tail", F.col("words") - (F.col("nb") - 1) * L)
    per = per.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(goal - 1) div words"))).alias("pass")) \
        .where("goal > 0")
    per = per.withColumn("pass_words", F.least(F.col("words"), F.col("goal") - F.col("pass") * F.col("words")))
    per = per.withColumn("tail_slot", permuted(F.col("nb") - 1, seed, inverse=True))
    per = per.withColumn("n", F.least(F.col("nb"), F.expr(f"pass_words div {block_words}") + 2))
    chunks = per.select("*", F.explode(F.expr(f"sequence(0L, (n - 1) div {SLOT_CHUNK})")).alias("chunk"))
    # a fixed number of tasks: the rows are few and small, what they make is not
    goal = targets.agg(F.sum("target")).first()[0] or 0
    chunks = chunks.repartition(max(1, math.ceil(goal / block_words / (4 * SLOT_CHUNK))), "sid", "pass", "chunk")
    made = chunks.select("*", F.explode(F.expr(
        f"sequence(chunk * {SLOT_CHUNK}, least(n, (chunk + 1) * {SLOT_CHUNK}) - 1)")).alias("slot"))
    made = made.withColumn("have", F.col("slot") * L - F.when(
        F.col("slot") > F.col("tail_slot"), L - F.col("tail")).otherwise(0))
    made = made.withColumn("take", F.least(
        F.col("pass_words") - F.col("have"),
        F.when(F.col("slot") == F.col("tail_slot"), F.col("tail")).otherwise(L))).where("take > 0")
    shard = F.pmod(F.xxhash64(F.lit(seed + 1), "sid", "pass", "slot"), F.lit(n_shards)).cast("int")
    made = made.withColumn("shard", shard).withColumn("_h", F.xxhash64(F.lit(seed + 2), "sid", "pass", "slot"))
    n_cells = max(1, math.ceil(goal / block_words / n_shards / SLOT_CHUNK))
    made = made.withColumn("_cell", F.pmod("_h", F.lit(n_cells)))
    counts = made.groupBy(F.col("shard").alias("_shard"), F.col("_cell").alias("_cell2")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_shard").orderBy("_cell2").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = counts.select("_shard", "_cell2", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("shard", "_cell").orderBy("_h", "sid", "pass", "slot"))
    placed = (made.withColumn("_at", within)
              .join(before, (F.col("shard") == F.col("_shard")) & (F.col("_cell") == F.col("_cell2"))))
    return placed.select("sid", "pass", "slot", "shard", (F.col("_before") + F.col("_at") - 1).alias("position"),
                         permuted(F.col("slot"), seed).alias("block"), "take")


def mix(docs: DataFrame, n_shards: int = 16, block_words: int = BLOCK_WORDS, seed: int = 7919,
        carry: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """The mix and the documents it was drawn from.

    First: (shard, position, sid, pass, slot, block, n_words, segments), a row per block
    taken; ``segments`` are its stretches of documents in order, (offset in the block,
    start, first_word, n_words), where ``start`` names the document within ``sid``.
    Second: the layout with (sid, words, target), written once as it is read repeatedly."""
    laid = layout(docs, carry)
    laid = written(laid, "mix-layout")
    targets = written(source_targets(laid.select("source", "size")), "mix-targets")
    named = targets.select("sid", F.col("source").alias("_src"), "words", "target")
    laid = laid.join(named, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    L = block_words
    blocks = (laid.where("size > 0").select("sid", "start", "size", F.explode(
        F.expr(f"sequence(start div {L}, (start + size - 1) div {L})")).alias("block"))
        .withColumn("first_word", F.greatest(F.lit(0).cast("long"), F.col("block") * L - F.col("start")))
        .withColumn("offset", F.col("start") + F.col("first_word") - F.col("block") * L)
        .withColumn("len", F.least(F.col("size") - F.col("first_word"), L - F.col("offset"))))
    # both sides grow with the corpus, though the slots come from few rows: never broadcast
    pieces = (slots(targets, n_shards, L, seed).hint("merge").join(blocks.hint("merge"), ["sid", "block"])
              .withColumn("n_words", F.least(F.col("len"), F.col("take") - F.col("offset")))
              .where("n_words > 0"))
    # the join's partitioning holds for the blocks: at most ``block_words`` stretches each, no shuffle
    packed = pieces.groupBy("sid", "block", "pass", "slot", "shard", "position").agg(
        F.sum("n_words").alias("n_words"),
        F.sort_array(F.collect_list(F.struct("offset", "start", "first_word", "n_words"))).alias("segments"))
    return packed.select("shard", "position", "sid", "pass", "slot", "block", "n_words", "segments"), laid


def write_blocks(packed: DataFrame, path: str) -> DataFrame:
    """The mix as a folder per shard, blocks by position; returns the table read back.
    A file holds runs of ``SLOT_CHUNK`` positions, so a shard is as many files as its size asks for."""
    (packed.repartition("shard", F.expr(f"position div {SLOT_CHUNK}")).sortWithinPartitions("shard", "position")
     .write.partitionBy("shard").parquet(path))
    return packed.sparkSession.read.schema(packed.schema).parquet(path)


def _stretches(packed: DataFrame) -> DataFrame:
    """(shard, position, sid, pass, offset, start, first_word, n_words) of the blocks written."""
    return packed.select("shard", "position", "sid", "pass", F.inline("segments"))


def _written_mix(docs: DataFrame, **kwargs) -> tuple[DataFrame, DataFrame]:
    packed, laid = mix(docs, **kwargs)
    return write_blocks(packed, fresh_dir(docs.sparkSession, "mix-blocks")), laid


def _slices(text: Column, at: Column, word: str, sep: str, also=()) -> Column:
    """Of each of the stretches ``at`` of a text its words joined (with the fields ``also``
    before them); the words are bound once, not found again for every stretch."""
    def piece(words: Column, p: Column) -> Column:
        cut = F.array_join(F.slice(words, (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")), sep)
        return F.struct(*[p[c].alias(c) for c in also], cut.alias("piece"))

    words = F.array(F.regexp_extract_all(text, F.lit(word), F.lit(0)))
    return F.get(F.transform(words, lambda w: F.transform(at, lambda p: piece(w, p))), F.lit(0))


def block_texts(docs: DataFrame, **kwargs) -> DataFrame:
    """(shard, position, n_words, text): the words of every block of the mix, joined by blanks."""
    packed, laid = _written_mix(docs.select("doc_id", "source", "text"), carry=("text",), **kwargs)
    per = _stretches(packed).groupBy("sid", "start").agg(F.collect_list(
        F.struct("shard", "position", "offset", "first_word", "n_words")).alias("at"))
    cut = (laid.where("size > 0").select("sid", "start", "text").join(per, ["sid", "start"])
           .select(F.inline(_slices(F.col("text"), F.col("at"), WORD, " ",
                                    ("shard", "position", "offset", "n_words")))))
    return cut.groupBy("shard", "position").agg(
        F.sum("n_words").alias("n_words"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", "piece"))), lambda p: p["piece"]), " ")
        .alias("text"))


def taken_words(docs: DataFrame, **kwargs) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    packed, laid = _written_mix(docs, **kwargs)
    got = _stretches(packed).groupBy("sid", "start").agg(F.sum("n_words").alias("got"))
    cols = ["doc_id", "size", F.col("words").alias("source_size"), "target"]
    full = (laid.where("size > 0").join(got, ["sid", "start"], "left")
            .select(*cols, F.coalesce("got", F.lit(0)).cast("long").alias("taken")))
    return full.unionByName(laid.where("size = 0").select(*cols, F.lit(0).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, **kwargs) -> DataFrame:
    """The mix as documents: a row per document and pass with the words taken, in order
    (the text itself where all of it is taken), columns as those of ``docs``. Documents
    of which nothing is taken, among them all without words, are left out."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed, laid = _written_mix(docs.withColumn("_row", row).select("doc_id", "source", "text", "_row"),
                                carry=("_row",), **kwargs)
    per = _stretches(packed).groupBy("sid", "start", "pass").agg(
        F.sum("n_words").alias("got"), F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("at"))
    joined = laid.where("size > 0").select("sid", "start", "size", "_row").join(per, ["sid", "start"])
    # white space after a word stays with it, white space before the first word is cut
    pieces = _slices(F.col("_row.text"), F.col("at"), WORD + r"[\x20\x09-\x0D]*", "")
    cut = F.array_join(F.transform(pieces, lambda p: p["piece"]), "")
    text = F.when(F.col("got") < F.col("size"), cut).otherwise(F.col("_row.text"))
    joined = joined.withColumn("_text", text)
    text = F.col("_text")
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(text.alias(c))
        elif c == "n_chars":
            out.append(F.length(text).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col("_row").getField(c).alias(c))
    return joined.select(*out)
