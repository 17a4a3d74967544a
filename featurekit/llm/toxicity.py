"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores z = bias + the weights of its
features, p = sigmoid(z); the document's score is their noisy-or, 1 - prod(1 - p).
Training sees document labels only: with a = sum(log(1 + e^z)) the score is
1 - e^-a, and the loss is the weighted cross-entropy on it, minimised by proximal
gradient steps with momentum (the l1 term keeps the few features that matter). The
sentence scores then locate the offending sentences.

Features of a sentence: its distinct words (lower-cased runs of letters, digits and
apostrophes) and the words' first 3, 4 and 5 characters. Nothing else of the row is an
input: not labels, lang, source or doc_id.

Training rows are a bounded sample of the labelled rows outside the held-out fold:
``TRAIN_BYTES`` of text per class, drawn by a hash of doc_id, each class weighted back
to its share. Everything is scored, whole texts, in one pass without a shuffle.

Defined results: null and empty texts, and those without a word, have no sentence and
score 0; without labels of both classes every score is 0; labels that are null, or
that contradict each other for one doc_id (then: the larger), are left out or merged;
equal rows score alike; further columns travel along.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import free_name
from featurekit.session import ship_package

TRAIN_BYTES = 6 << 20
MIN_DOCS = 3
STEPS = 120
L1 = 1e-3
THRESHOLD = 0.7
PREFIXES = (3, 4, 5)
CACHE = 200_000
#: Features of sentences looked at together in a step of the training.
PART = 1 << 18

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)*")


def sentences(text) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of the sentences with a word."""
    out = []
    for m in _SENTENCE.finditer(text or ""):
        words = _WORD.findall(m.group().lower())
        if words:
            out.append((m.start(), m.end(), words))
    return out


def features(word: str) -> list[str]:
    return [word, *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]


def train(rows: list[tuple[str, int, float]]) -> tuple[float, dict[str, float]]:
    """(bias, weights) from (text, label, weight) rows."""
    known: dict[str, int] = {}  # feature to number
    of_word: dict[str, tuple] = {}
    cols, lengths, bag_of, bags = array("i"), array("i"), array("i"), []
    n_docs = np.zeros(0, np.int32)
    for text, label, weight in rows:
        first = len(cols)
        for _, _, words in sentences(text):
            own: set = set()
            for w in words:
                if w not in of_word:
                    of_word[w] = tuple(known.setdefault(f, len(known)) for f in features(w))
                own.update(of_word[w])
            cols.extend(sorted(own))
            lengths.append(len(own))
            bag_of.append(len(bags))
        if len(cols) > first:
            bags.append((label, weight))
            if len(known) > len(n_docs):
                n_docs = np.concatenate([n_docs, np.zeros(len(known), np.int32)])
            n_docs[np.unique(np.array(cols[first:]))] += 1
    if len({y for y, _ in bags}) < 2:
        return -50.0, {}
    kept = np.flatnonzero(n_docs >= MIN_DOCS)
    number = np.full(len(n_docs), -1, np.int32)
    number[kept] = np.arange(len(kept))
    cols = number[np.frombuffer(cols, np.int32)]
    sent_of = np.repeat(np.arange(len(lengths), dtype=np.int32), np.frombuffer(lengths, np.int32))[cols >= 0]
    cols, bag_of = cols[cols >= 0], np.frombuffer(bag_of, np.int32)
    # one text holds the names meanwhile, so that the words' memory is given back
    held = sorted((int(number[i]), f) for f, i in known.items() if number[i] >= 0)
    names = "\n".join(f for _, f in held)
    del known, of_word, held
    y = np.array([b[0] for b in bags], float)
    weight = np.array([b[1] for b in bags])
    weight = weight * np.where(y == 1, 0.5 / weight[y == 1].sum(), 0.5 / weight[y == 0].sum())
    n, n_sent = len(kept), len(bag_of)
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = -4.0
    parts = [slice(lo, lo + PART) for lo in range(0, len(cols), PART)]
    for t in range(1, STEPS + 1):
        z = np.zeros(n_sent)
        for p in parts:
            np.add.at(z, sent_of[p], w[cols[p]])
        z += w[n]
        a = np.maximum(np.bincount(bag_of, np.logaddexp(0, z), len(y)), 1e-12)
        slope = weight * np.where(y == 1, -1 / np.expm1(np.minimum(a, 500)), 1.0)
        g = slope[bag_of] / (1 + np.exp(-z))
        grad = np.zeros(n + 1)
        for p in parts:
            np.add.at(grad, cols[p], g[sent_of[p]])
        grad[n] = g.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        rate = 0.3 * (1 - t / (STEPS + 1)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-5)
        w = w - rate * m / (1 - 0.9 ** t)
        w[:n] = np.sign(w[:n]) * np.maximum(np.abs(w[:n]) - rate[:n] * L1, 0)
    return float(w[n]), {f: float(x) for f, x in zip(names.split("\n"), w[:n].tolist(), strict=True) if x} if n else {}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_bytes: int = TRAIN_BYTES):
    """Model from the labelled documents. Each class gives whole texts of about
    ``train_bytes`` in all, chosen by a hash of doc_id; that bound is what the driver holds."""
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").alias("_id")).agg(F.max(label).cast("int").alias("y"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    sizes = docs.select("doc_id", size.alias("size")).join(marks, F.col("doc_id") == F.col("_id"))
    total = {r["y"]: r["n"] for r in sizes.groupBy("y").agg(F.sum("size").alias("n")).collect()}
    rate = {y: min(1.0, train_bytes / n) for y, n in total.items()}
    chance = F.pmod(F.xxhash64(F.lit(17), "_id"), F.lit(1 << 30)) / float(1 << 30)
    cut = F.lit(0.0)
    for y, r in rate.items():
        cut = F.when(F.col("y") == y, r).otherwise(cut)
    # the ids of about train_bytes of text per class, at 64 bytes a row at least: so many
    # are broadcast, and no text is shuffled
    chosen = sizes.where(chance < cut).select("_id", "y").distinct()
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select(
        "text", "y").collect()
    return train(sorted((r["text"] or "", int(r["y"] > 0), 1 / rate[r["y"]]) for r in sample))


def _scorer(shared):
    known: dict[str, float] = {}

    def value(word: str, weights: dict[str, float]) -> float:
        if len(known) > CACHE:
            known.clear()
        return known.setdefault(word, sum(weights.get(f, 0.0) for f in features(word)))

    def score(texts: pd.Series) -> pd.DataFrame:
        bias, weights = shared.value
        rows = []
        for text in texts:
            a, starts, ends = 0.0, [], []
            for lo, hi, words in sentences(text):
                # a prefix that two words share counts once: take it from the distinct features
                z = bias
                hot = [w for w in set(words) if (known[w] if w in known else value(w, weights))]
                if hot:
                    z += sum(weights.get(f, 0.0) for f in {f for w in hot for f in features(w)})
                s = np.logaddexp(0, z) if z > -30 else 0.0
                a += s
                if z >= 0:
                    starts.append(lo)
                    ends.append(hi)
            rows.append((float(-np.expm1(-a)), starts, ends))
        return pd.DataFrame(rows, columns=["score", "starts", "ends"])
    return F.pandas_udf(score, "score double, starts array<int>, ends array<int>")


def scored(docs: DataFrame, model, out: str = "toxicity") -> DataFrame:
    """``docs`` with struct ``out``: score, and the spans (code points) of the sentences
    that alone are more likely toxic than not."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(free_name(docs, out), _scorer(shared)(F.col("text")))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, columns unchanged."""
    out = free_name(docs, "toxicity")
    marked = scored(docs, fit(docs, training_labels(labels)), out)
    return marked.where(F.col(out)["score"] < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out(F.col("doc_id")))
