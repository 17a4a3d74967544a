"""Secret scan with a random forest that removes false positives.

Candidates are the maximal runs of ``A-Za-z0-9+/_.@=-`` with a digit and at least
``MIN_CHARS`` characters (after ``name=``, if the run starts so), and whatever follows a
credential name and ``=`` or ``:``, or starts with a provider's prefix: any characters, at
any length, up to white space or the closing quote (unquoted values also end before
``&name=`` and leave closing punctuation out). Of two that start together the longer
counts. The forest sees, per
candidate: length; character classes and their transitions, entropy, and the mean log
probability of its letter pairs in the corpus; how much of it dictionary words cover
(all words seen ``LEAST_COUNT`` times in the corpus, looked up in a bitmap of fixed size
that takes a few others for words: under one in 100 with ten million words); path and address
marks; and the neighbouring words (name it is assigned to, hashed words before and
after). It is trained with Spark ML on labelled findings, a sample bounded by
``TRAIN_ROWS``, and scores every finding.

``labelled`` findings are (doc_id, start, label). Where no such table is given,
``weak_labels`` marks the findings whose form settles the matter (provider key formats
and values assigned to credential names; addresses, numbers and dates), outside the
held-out fold.

Defined results: null and empty texts have no findings; a run is one finding however
long; findings that repeat are each reported; without labels of both kinds every
finding scores 0.5; a null doc_id is kept; an empty table gives no findings; further
columns are left aside. The secret itself is not returned, only its SHA-256.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from featurekit.llm import jaccard
from featurekit.llm.common import written
from featurekit.session import ship_package

MIN_CHARS = 8
LEAST_COUNT = 3
TRAIN_ROWS = 50_000
HASHED_WORDS = 16
CONTEXT = 64
FLUSH = 400_000

_DIGIT = re.compile(r"[0-9]")
_RUN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.@=-")
_ASSIGNED = re.compile(r"([A-Za-z_][\w.\-]*)[\"']?\s{0,2}(?::=|=>|[:=])\s{0,2}(?:(?:Bearer|Basic)\s)?[\"'`]?$")
_GIVEN = re.compile(r"(?::=|=>|[:=])\s{0,2}(?:(?:Bearer|Basic)\s)?([\"'`]?)")
_PREFIX = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA|gh[pousr]_|sk-|xox[abp]-)(?=[^\s\"'`])")
_UNQUOTED = re.compile(r"(?:(?![&;,?][\w.\-]+=)[^\s\"'`]|(?<=\w)[\"'`](?=\w))+")
_QUOTED = {q: re.compile(rf"[^\s{q}]+") for q in "\"'`"}
_NAMED = re.compile(r"([A-Za-z_][A-Za-z0-9_.\-]*)=(.+)", re.DOTALL)
_CREDENTIAL = re.compile(r"passw|pwd|secret|token|api_?key|access_?key|credential|auth", re.IGNORECASE)
_PROVIDER = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}$|gh[pousr]_[A-Za-z0-9]{20,}$|sk-[A-Za-z0-9]{20,}$|xox[abp]-[\w-]{10,}$")
_HARMLESS = re.compile(r"[^@]+@[^@]+\.[a-z]+$|\d{1,3}(?:\.\d{1,3}){3}$|[\d.\-/+]+$")
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

FINDINGS = ("doc_id long, start long, end long, name string, sha256 string, weak int, features array<double>")


def digit_runs(text: str):
    """(start, end) of the runs with a digit and ``MIN_CHARS`` characters, in order."""
    at, n = 0, len(text)
    while m := _DIGIT.search(text, at):
        lo, hi = m.start(), m.end()
        while lo > at and text[lo - 1] in _RUN:
            lo -= 1
        while hi < n and text[hi] in _RUN:
            hi += 1
        at = hi
        end = hi
        while end > lo and text[end - 1] in ".-":
            end -= 1
        while lo < end and text[lo] in ".=":
            lo += 1
        if (named := _NAMED.match(text, lo, end)) and any(c.isdigit() for c in named.group(2)):
            lo = named.start(2)
        if end - lo >= MIN_CHARS:
            yield lo, end


def given_values(text: str):
    """(start, end) of the values of credential names and of what has a provider's prefix;
    of values inside one another, the outermost, so a text's values are at most its length."""
    done = 0
    for sign in _GIVEN.finditer(text):
        if sign.end() < done:
            continue
        before = text[max(0, sign.start() - CONTEXT):sign.end()]
        if not _CREDENTIAL.search(before) or not (m := _ASSIGNED.search(before)) or not _CREDENTIAL.search(m.group(1)):
            continue
        if found := _value(text, sign.end(), sign.group(1)):
            done = found[1]
            yield found
    done = 0
    for m in _PREFIX.finditer(text):
        if m.start() >= done and (found := _value(text, m.start(), text[m.start() - 1:m.start()])):
            done = found[1]
            yield found


def _value(text: str, lo: int, before: str):
    quoted = _QUOTED.get(before)
    m = (quoted or _UNQUOTED).match(text, lo)
    if not m:
        return None
    hi = m.end()
    if not quoted:
        while hi > lo and text[hi - 1] in ".,;:)]}>":
            hi -= 1
    return (lo, hi) if hi > lo else None


def runs(text: str):
    """(start, end) of the candidates of a text, in order."""
    ends: dict[int, int] = {}
    for lo, hi in (*digit_runs(text), *given_values(text)):
        ends[lo] = max(hi, ends.get(lo, 0))
    return sorted(ends.items())


class Words:
    """Set of words as a bitmap: each sets the bits of some parts of its hash."""

    SHIFTS = (0, 18, 37)

    def __init__(self, bits: bytes):
        self.bits = bits

    def __contains__(self, word: str) -> bool:
        h = xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42)  # Spark's xxhash64
        slots = [h >> s & (jaccard.BITMAP_BITS - 1) for s in self.SHIFTS]
        return all(self.bits[x >> 3] >> (x & 7) & 1 for x in slots)


def covered(value: str, words) -> float:
    """Share of the characters in dictionary words, the longest first from the left."""
    low, at, got, stop = value.lower(), 0, 0, 0
    while at < len(low):
        while stop < len(low) and ("a" <= low[stop] <= "z" or low[stop] >= "\x80"):
            stop += 1
        for n in range(min(12, stop - at), 2, -1):
            if low[at:at + n] in words:
                got, at = got + n, at + n
                break
        else:
            at += 1
            stop = max(stop, at)
    return got / max(1, len(low))


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def _letter(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else 26


def vector(text: str, lo: int, hi: int, name: str, words, pairs: np.ndarray) -> list[float]:
    value = text[lo:hi]
    n = len(value)
    kinds = [_kind(c) for c in value]
    share = [kinds.count(k) / n for k in range(4)]
    counts = Counter(value).values()
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    letters = [_letter(c) for c in value.lower()]
    likely = float(np.mean(pairs[letters[:-1], letters[1:]])) if n > 1 else 0.0
    before, after = text[max(0, lo - CONTEXT):lo], text[hi:hi + CONTEXT]
    around = [0.0] * HASHED_WORDS
    near = re.findall(r"\w+", before.lower())[-3:] + re.findall(r"\w+", after.lower())[:1]
    for w in near:
        around[zlib.crc32(w.encode()) % HASHED_WORDS] += 1.0
    return [float(n), *share, entropy, sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n, likely,
            len(set(value)) / n, covered(value, words), value.count("/") / n, value.count(".") / n,
            float("@" in value), float(before[-1:] in ("/", "\\", ":")), float(after[:1] in ("/", "\\", ":")),
            float(bool(re.search(r"\.[A-Za-z]{1,4}$", value))), float(bool(name)),
            float(bool(_CREDENTIAL.search(" ".join([name, *near])))), float(before[-1:] in ("'", '"')), *around]


def _words(batches):
    seen: Counter = Counter()

    def out():
        rows = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                          ["word", "n"])
        seen.clear()
        return rows

    for b in batches:
        for t in b.column(0).to_pylist():
            if t:
                seen.update(t.encode("utf-8", "surrogatepass").translate(_LETTERS).split())
            if len(seen) > FLUSH:
                yield out()
    if seen:
        yield out()


def _pairs(batches):
    seen = np.zeros((27, 27), np.int64)
    for b in batches:
        for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            codes = [_letter(c) for c in word.decode("utf-8", "replace")]
            for x, y in zip(codes, codes[1:], strict=False):
                seen[x, y] += n
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen.ravel()[at], pa.int64())], ["pair", "n"])


def dictionary(docs: DataFrame) -> tuple[Words, np.ndarray]:
    """The corpus's words of 3 to 12 letters seen ``LEAST_COUNT`` times, and log
    probabilities of the letter pairs in all of that length (the 27th letter is anything
    else). The driver gets the bitmap and at most 27 x 27 rows."""
    counts = written(docs.select("text").mapInArrow(_words, "word binary, n long")
                     .where(F.length("word").between(3, 12)).groupBy("word").agg(F.sum("n").alias("n")), "words")
    h = F.xxhash64("word")
    bits = jaccard._bits(counts.where(F.col("n") >= LEAST_COUNT).select(
        F.explode(F.array(*[F.shiftrightunsigned(h, s) for s in Words.SHIFTS])).alias("token")))
    pairs = np.ones((27, 27))
    for r in counts.mapInArrow(_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[divmod(r["pair"], 27)] += r["n"]
    return Words(bits.tobytes()), np.log(pairs / pairs.sum(axis=1, keepdims=True))


def weak_label(value: str, name: str, words=frozenset()) -> int | None:
    if _PROVIDER.match(value):
        return 1
    if _CREDENTIAL.search(name):
        if len(value) >= MIN_CHARS and _DIGIT.search(value):
            return 1
        return 0 if value.isalpha() and value.lower() in words else None  # "author: Smith"
    return 0 if _HARMLESS.match(value) else None


def _scanner(shared):
    def scan(batches):
        words, pairs = shared.value
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for lo, hi in runs(text or ""):
                    m = _ASSIGNED.search(text[max(0, lo - CONTEXT):lo])
                    name = m.group(1) if m else ""
                    value = text[lo:hi]
                    for c, v in zip(cols, (doc, lo, hi, name, hashlib.sha256(value.encode("utf-8", "replace")).hexdigest(),
                                           weak_label(value, name, words), vector(text, lo, hi, name, words, pairs)), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.float64())),
                strict=True)], ["doc_id", "start", "end", "name", "sha256", "weak", "features"])
    return scan


def findings(docs: DataFrame) -> DataFrame:
    """Every candidate of every text with its features, written once."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = spark.sparkContext.broadcast(dictionary(docs))
    return written(docs.mapInArrow(_scanner(shared), FINDINGS), "findings")


def weak_labels(found: DataFrame) -> DataFrame:
    """(doc_id, start, label) of the findings that their form settles, outside the
    held-out third of the ids."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3, F.lit(0))
    return found.where("weak IS NOT NULL").where(fold != 1).select("doc_id", "start", F.col("weak").alias("label")).distinct()


def classified(found: DataFrame, labelled: DataFrame, threshold: float = 0.5, seed: int = 11) -> DataFrame:
    """``found`` with ``probability`` (of a secret) and ``is_secret``."""
    marks = labelled.where("label IS NOT NULL").groupBy("doc_id", "start").agg(F.max("label").cast("double").alias("label"))
    rows = found.join(marks, ["doc_id", "start"]).select("label", "features", F.xxhash64(F.lit(seed), "doc_id", "start").alias("h"))
    by_label = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(by_label) < 2:
        return found.withColumn("probability", F.lit(0.5)).withColumn("is_secret", F.lit(False))
    share = min(1.0, TRAIN_ROWS / sum(by_label.values()))
    least = min(by_label.values())
    train = rows.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).withColumn(
        "weight", F.when(F.col("label") == 1, least / by_label[1.0]).otherwise(least / by_label[0.0]))
    train = written(train.select("label", "weight", "features"), "labelled").select(
        "label", "weight", array_to_vector("features").alias("x"))
    forest = RandomForestClassifier(featuresCol="x", weightCol="weight", numTrees=24, maxDepth=6,
                                    probabilityCol="p", rawPredictionCol="raw", predictionCol="y", seed=seed)
    scored = forest.fit(train).transform(found.withColumn("x", array_to_vector("features")))
    probability = F.get(vector_to_array("p"), F.lit(1))
    return scored.select(*found.columns, probability.alias("probability"), (probability >= threshold).alias("is_secret"))
