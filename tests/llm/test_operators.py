"""The operators on odd tables: every case must give its defined result."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurekit.llm import (
    chat,
    components,
    decontam,
    jaccard,
    linedup,
    mixing,
    queries,
    secretscan,
    sharding,
    tokenids,
    toxicity,
    winnow,
)
from featurekit.session import fresh_dir
from tests.conftest import SMOKE
from tests.llm.conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}


# ------------------------------------------------------------------ sharding
def test_sharding_law_on_odd_rows(odd, clashing, empty):
    for docs in (odd, clashing):
        out = sharding.external_shuffle(docs, n_shards=4, bucket_bytes=1 << 10)
        rows = out.collect()
        assert len(rows) == docs.count()
        sizes = Counter(r["shard"] for r in rows)
        assert max(sizes.values()) - min(sizes.values()) <= 1
        for s in sizes:
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
        assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
        again = {(r["shard"], r["slot"]): r["doc_id"] for r in
                 sharding.external_shuffle(docs, n_shards=4, bucket_bytes=1 << 10).collect()}
        assert again == {(r["shard"], r["slot"]): r["doc_id"] for r in rows}
    assert sharding.external_shuffle(empty).count() == 0


def test_sharding_writes_all(spark, odd):
    back = sharding.write_shards(odd, fresh_dir(spark, "t"), n_shards=20)
    assert back.count() == odd.count() and back.select("shard").distinct().count() == odd.count()


def test_sharding_splits_repeated_records(spark):
    """A third of the rows equal (and as many with null ids): no bucket holds more than a few times its share."""
    row = "repeated text " * 8
    docs = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") + 100).cast("long").alias("doc_id"),
        F.when(F.col("id") % 3 < 2, F.lit(row)).otherwise(F.lit(row.upper())).alias("text"))
    size = 1 << 14
    keyed = sharding._hashed(docs, 5, size, "h")
    n = docs.select(F.sum(F.octet_length("text") + 64)).first()[0] // size + 1
    most = keyed.groupBy(F.pmod("h", F.lit(n))).count().agg(F.max("count")).first()[0]
    assert keyed.count() == 6000 and most < 3 * 6000 / n
    out = sharding.external_shuffle(docs, n_shards=7, bucket_bytes=size).cache()
    assert out.count() == 6000 and out.select("shard", "slot").distinct().count() == 6000
    assert sorted(r["count"] for r in out.groupBy("shard").count().collect())[0] == 857
    assert Counter(map(tuple, out.select("doc_id", "text").collect())) == Counter(map(tuple, docs.collect()))


# -------------------------------------------------------------------- mixing
def _fill(sizes):
    """Targets by repeated resharing, as the contract says."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
        open_ -= set(over)
    return target


@pytest.mark.parametrize("table", ["odd", "clashing", "smoke"])
def test_mixing_targets_and_takes(spark, table, request):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet") if table == "smoke" else request.getfixturevalue(table)
    source = {(r.doc_id, r.text): r.source for r in docs.collect()}
    out = mixing.taken_words(docs, block_words=16).collect()
    assert len(out) == docs.count()
    sizes, taken = Counter(), Counter()
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want = _fill(sizes)
    assert out == mixing.taken_words(docs, block_words=16).collect() or sorted(map(str, out)) == sorted(
        map(str, mixing.taken_words(docs, block_words=16).collect()))
    per = {(round(r["source_size"], 3), round(r["target"], 6)) for r in out}
    assert per <= {(sizes[s], round(want[s], 6)) for s in sizes}
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    if table == "smoke":
        for r in out:
            taken[source[next(k for k in source if k[0] == r["doc_id"])]] += r["taken"]
        assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_mixing_blocks_by_shard(spark):
    """The blocks written: positions gapless in each shard, counts per source those of a uniform
    draw, sources mixed along a shard, and their words those of the documents taken."""
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    packed, laid = mixing._written_mix(docs, n_shards=4, block_words=16)
    rows = packed.collect()
    by_shard, by_source = {}, Counter(r["sid"] for r in rows)
    for r in rows:
        by_shard.setdefault(r["shard"], {})[r["position"]] = r
        assert 0 < r["n_words"] <= 16 and r["n_words"] == sum(s["n_words"] for s in r["segments"])
        assert all(a["offset"] + a["n_words"] == b["offset"] for a, b in zip(r["segments"], r["segments"][1:]))
    assert len(by_shard) == 4 and all(sorted(p) == list(range(len(p))) for p in by_shard.values())
    assert len({(r["sid"], r["pass"], r["slot"]) for r in rows}) == len({(r["sid"], r["pass"], r["block"]) for r in rows}) == len(rows)
    for s, blocks in by_shard.items():
        for sid, n in by_source.items():
            here = [p for p, r in blocks.items() if r["sid"] == sid]
            assert abs(len(here) - n / 4) <= 5 * (n * 3 / 16) ** 0.5 + 1
            if len(here) > 200:  # spread over the shard
                assert abs(sum(here) / len(here) / len(blocks) - 0.5) < 0.1
    texts = mixing.block_texts(docs, n_shards=4, block_words=16).collect()
    assert {(r["shard"], r["position"], r["n_words"]) for r in texts} == {(r["shard"], r["position"], r["n_words"]) for r in rows}
    words = Counter(w for r in texts for w in r["text"].split(" "))
    assert words.total() == sum(r["n_words"] for r in rows)
    mixed = mixing.mixed_documents(docs, n_shards=4, block_words=16)
    assert words == Counter(w for r in mixed.collect() for w in WORD.findall(r["text"]))


def test_mixing_permutation_is_one(spark):
    for nb in (1, 2, 3, 17, 1000):
        df = spark.range(nb).select(F.col("id").alias("x0"), F.lit(5).cast("long").alias("sid"),
                                    F.lit(1).cast("long").alias("pass"), F.lit(nb).cast("long").alias("nb"))
        df = df.withColumn("y0", mixing.permuted(F.col("x0"), 3)).withColumn(
            "z0", mixing.permuted(F.col("y0"), 3, inverse=True))
        rows = df.collect()
        assert sorted(r["y0"] for r in rows) == list(range(nb)) and all(r["x0"] == r["z0"] for r in rows)


def test_mixed_documents_hold_the_words_taken(spark, odd, clashing, empty):
    for docs in (odd, clashing):
        out = mixing.mixed_documents(docs, block_words=4)
        assert out.columns == docs.columns
        words = Counter()
        for r in out.collect():
            words[r["doc_id"]] += len(WORD.findall(r["text"]))
        want = Counter()
        for r in mixing.taken_words(docs, block_words=4).collect():
            want[r["doc_id"]] += r["taken"]
        assert +words == +want
    assert mixing.taken_words(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


# ----------------------------------------------------------- decontamination
def test_decontamination_odd_rows_and_blocks(spark, odd, clashing, empty):
    items = spark.createDataFrame(
        [(1, "two three four five six seven eight nine ten eleven"), (2, "SHORT"), (3, None), (4, ""), (2, "short"),
         (5, "ñandú 日本語"), (6, "seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen 17"), (None, "filler1")],
        "item_id long, text string")
    for block_bytes in (1 << 22, 30):
        for docs in (odd, clashing):
            rows = decontam.annotate(docs, items, "found", block_bytes).select("doc_id", "found").collect()
            got = defaultdict(list)
            for r in rows:
                f = r["found"]
                got[r["doc_id"]].append((f["n_words"], sum(f["ends"]) - sum(f["starts"]), f["items"]))
            assert got[1] == [(14, 10, ["1"])] * 3 and got[2] == [(14, 10, ["1"])]
            assert got[3] == got[4] == got[5] == [(0, 0, [])]
            assert got[7] == [(1, 1, ["2"])] and got[8] == [(4, 2, ["5"])]
            assert got[9] == [(16, 15, ["1", "6"])]
            assert got[6][0][2] == ["null"]
    assert decontam.annotate(empty, items).count() == 0
    assert decontam.clean_documents(odd, items.where("false")).count() == odd.count()
    assert decontam.clean_documents(clashing, items).columns == clashing.columns


# ------------------------------------------------------------------- jaccard
def _links(texts, n, percent):
    sets, at = {}, defaultdict(list)
    for i, t in texts.items():
        w = t.encode().lower().split()
        s = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        sets[i] = s
        for x in s:
            at[x].append(i)
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in at[x] if j < i).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_matches_brute_force(spark, n, percent):
    rng = np.random.default_rng(n)
    texts = documents(spark)
    for i in list(texts):  # edits at many distances, around the limit too
        w = texts[i].split(" ")
        for k in range(2):
            e = list(w)
            for j in rng.integers(0, len(w), max(1, len(w) * (k + 1) // 60)):
                e[j] = f"x{rng.integers(0, 9)}"
            texts[1000 * (k + 1) + i] = " ".join(e)
    docs = frame(spark, [(i, t, None, None, None) for i, t in texts.items()]).repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.components(docs, n, percent).collect()}
    assert got == _links(texts, n, percent)


def test_jaccard_hot_group(spark):
    """Many near copies of one text: frequent tokens, combinations and several pivots."""
    words = [f"w{i}" for i in range(300)]
    texts = {}
    for i in range(120):
        w = list(words)
        w[(i * 7) % 300] = f"e{i}"
        w[(i * 13 + 5) % 300] = f"f{i}"
        texts[i] = " ".join(w)
    for i in range(120, 160):
        texts[i] = " ".join(words[:150] + [f"g{i}-{j}" for j in range(150)])  # half shared: no link
    docs = frame(spark, [(i, t, None, None, None) for i, t in texts.items()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.components(docs, 3, 90).collect()}
    assert got == _links(texts, 3, 90)


def test_jaccard_pair_comes_from_one_of_its_signatures():
    """Near sets that share ten signatures are one pair, not ten; where a signature stands outside
    both sets' lowest ones, the pair is not lost."""
    import pyarrow as pa
    words = [f"w{i}" for i in range(100)]
    sets = [jaccard.token_set(" ".join(words[:95] + [f"e{i}"]), 3) for i in range(4)]
    fps = [bytes([i]) * 16 for i in range(4)]

    def batch(sigs, low):
        rows = [(s, 0, 0, 0, 0, fps[i], len(sets[i]), fps[i], jaccard.sketch(sets[i]), [x for x in low if x < s])
                for s in sigs for i in range(4)]
        types = [pa.int64(), *[pa.int32()] * 4, pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        names = ["sig", "i", "j", "side", "across", "fp", "n", "root", "sketch", "low"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def pairs(sigs, low, forest):
        return [(a, b) for x in jaccard._cross_pairs(90, forest)([batch(sigs, low)])
                for a, b in zip(x["a"].to_pylist(), x["b"].to_pylist(), strict=True)]

    every = {(fps[i], fps[j]) for i in range(4) for j in range(i + 1, 4)}
    got = pairs(range(10), range(10), False)
    assert len(got) == 6 and set(got) == every
    assert len(pairs(range(10), range(10), True)) == 3
    assert set(pairs(range(20, 23), [], False)) == every


def test_jaccard_odd_rows(odd, clashing, empty):
    rows = jaccard.components(odd, 5, 80).collect()
    assert len(rows) == odd.count()
    got = defaultdict(set)
    for r in rows:
        got[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert got[1] == got[2] == {(10, 1)} and got[9] == {(12, 1)}
    assert got[3] == {(0, 3)} and got[4] == {(0, 4)} and got[5] == {(0, 5)} and got[7] == {(1, 7)}
    kept = jaccard.representatives(clashing, 5, 80)
    assert kept.columns == clashing.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 4, 5, 6, 7, 8, None}
    assert jaccard.components(empty).count() == 0


def test_sketches_never_exceed_the_difference():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 500, 513, 1000, 1030, 5000, 9000, 20000)]
    sets += [np.unique(np.concatenate([s, rng.integers(0, 2**63, 40).astype(np.uint64)])) for s in sets]
    x = jaccard.Sketches(pa.array([jaccard.sketch(s) for s in sets]))
    i, j = (v.ravel() for v in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    for a, b, d in zip(i, j, x.apart(i, x, j), strict=True):
        assert d <= len(np.setxor1d(sets[a], sets[b])) and (d == 0 if a == b else d > 0)


def test_components_on_a_path(spark):
    n = 70
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(n) if i != 40], "a string, b string")
    got = {r["v"]: r["root"] for r in components.connected(edges).collect()}
    assert all(got[f"{i:03d}"] == ("000" if i <= 40 else "041") for i in range(n + 1))


# ------------------------------------------------------------------ winnowing
def _winnow(text, k, w):
    """Positions by brute force, given the operator's own hash order."""
    words = WORD.findall(text)
    return max(0, len(words) - k + 1)


def test_winnow_guarantee_and_ties(spark, odd):
    k, w = winnow.K_WORDS, winnow.WINDOW
    rep = " ".join(["same"] * 60)  # all hashes equal: the rightmost of every window
    shared = " ".join(f"s{i}" for i in range(k + w - 1))
    rows = [(1, rep), (2, "a b c " + shared + " d e"), (3, "x " + shared + " y z q"), (4, "one two"), (5, "a b c d e f")]
    df = winnow.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "h", "p")
    got = {r["doc_id"]: (r["h"], r["p"]) for r in df.collect()}
    assert got[1][1] == list(range(w - 1, 56)) and len(set(got[1][0])) == 1
    assert set(got[2][0]) & set(got[3][0])
    assert got[4][1] == [0] and len(got[5][1]) == 1
    for h, p in got.values():
        assert p == sorted(p) and len(h) == len(p)
    out = {r["doc_id"]: r["h"] for r in winnow.fingerprint(odd, "text", "h", "p").collect()}
    assert out[3] == out[4] == out[5] == [] and out[1] == out[2]


def test_winnow_matches_windows(spark):
    texts = documents(spark)
    df = spark.createDataFrame([(i, t) for i, t in list(texts.items())[:40]], "doc_id long, text string")
    every = {r["doc_id"]: r for r in winnow.fingerprint(df, "text", "h", "p", window=1).collect()}
    for r in winnow.fingerprint(df, "text", "h", "p").collect():
        hashes = every[r["doc_id"]]["h"]
        assert every[r["doc_id"]]["p"] == list(range(_winnow(texts[r["doc_id"]], 5, 1) or min(1, len(hashes))))
        want = []
        for i in range(max(1, len(hashes) - winnow.WINDOW + 1)):
            win = hashes[i:i + winnow.WINDOW]
            if win:
                j = i + max(x for x, h in enumerate(win) if h == min(win))
                if not want or want[-1] != j:
                    want.append(j)
        assert r["p"] == want and r["h"] == [hashes[j] for j in want]


def test_winnow_next_document(spark, odd, clashing, monkeypatch):
    monkeypatch.setattr(winnow, "BUCKET_DOCS", 7)  # many buckets
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["next_text"] for r in winnow.with_next(docs, ["text"], lambda d: d).collect()}
    texts = documents(spark)
    order = sorted(texts, reverse=True)
    assert got == {d: texts[order[(i + 1) % len(order)]] for i, d in enumerate(order)}
    for frame_ in (odd, clashing):
        assert winnow.with_next(frame_, ["text"], lambda d: d).count() == odd.count()


# ------------------------------------------------------------------ token ids
def test_token_ids_round_trip(spark, odd, empty):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    more = [(20, "a  b \n c <|endoftext|> d", None, None, 0), (21, "x\u00a0 y it's \r\n z  ", None, None, 0),
            (22, "\n foo", None, None, 0), (23, "foo \nfoo foo", None, None, 0)]
    docs = odd.unionByName(frame(spark, more))
    folder = fresh_dir(spark, "ids")
    tokenids.write(docs, folder, path)
    rows = tokenids.read(spark, folder).orderBy("start").collect()
    assert len(rows) == docs.count()
    start = 0
    for r, d in zip(rows, sorted(docs.collect(), key=lambda d: (d.doc_id is not None, d.doc_id or 0, d.text or "")), strict=True):
        ids = t.encode(d.text or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (d.doc_id, start, len(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        start += len(ids)
    folder = fresh_dir(spark, "ids")
    tokenids.write(empty, folder, path)
    assert tokenids.read(spark, folder).count() == 0


def test_rans_checkpoints_decode_alone():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 300_000).astype(np.int64) % 5000
    counts = np.bincount(ids, minlength=6000)
    t = tokenids.Tables(tokenids.scaled(counts))
    words, points = tokenids.encode(ids, t)
    assert (tokenids.decode(words, points[0], len(ids), t) == ids).all()
    for p in points[1:]:
        part = tokenids.decode(words, p, len(ids), t, tokenids.CHECK_STEPS)
        at = p[0] * tokenids.LANES
        assert (part == ids[at:at + len(part)]).all()
    one = tokenids.Tables(tokenids.scaled(np.array([0, 0, 9])))
    words, points = tokenids.encode(np.full(5000, 2), one)
    assert len(words) == 0 and (tokenids.decode(words, points[0], 5000, one) == 2).all()
    assert tokenids.scaled(np.arange(60_000)).sum() == 1 << tokenids.SCALE_BITS


def test_token_ids_detect_damage(spark):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    folder = fresh_dir(spark, "ids")
    tokenids.write(spark.createDataFrame([(1, "some words that are coded")], "doc_id long, text string"), folder, path)
    blocks = spark.read.parquet(f"{folder}/blocks")
    other = fresh_dir(spark, "ids")
    blocks.withColumn("crc32", F.col("crc32") + 1).write.parquet(f"{other}/blocks")
    spark.read.parquet(f"{folder}/frequencies").write.parquet(f"{other}/frequencies")
    with pytest.raises(Exception, match="checksum"):
        tokenids.read(spark, other).collect()


# ------------------------------------------------------------------------ chat
def test_chat_escapes_any_text():
    for text in ("", "\\", "\\\\", "###", "\\###", "</turn>", "\\</turn>\n", "a: b", "#####", queries.TRAP, "x\\"):
        for role in ("user", "", "a:b", "r\n", "\\", "### x", "</turn>"):
            written, lo, hi = chat.format_turn(role, text)
            assert chat.parse(written + chat.format_turn("user", text)[0]) == [(role, text), ("user", text)]
            assert chat.unescape(written[lo:hi]) == text


def test_chat_packs(spark, monkeypatch):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {t} {c // 4 if t < 2 else c}") for c in range(40) for t in range(4)]
    rows += [(100 + c, t, r, x) for c in range(30) for t, r, x in ((0, "user", "hot"), (1, "assistant", "same"))]
    rows += [(200, None, None, None), (200, 0, "user", None), (None, 1, "assistant", "nobody"), (201, 0, "user", "dup"),
             (201, 0, "user", "dup"), (-7, 0, "user", queries.TRAP), (-7, 1, "assistant", queries.TRAP)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("path", F.lit("x"))
    packs = chat.pack(turns, partitions=2)
    got = {r["conv_id"]: r for r in chat.unpack(packs).collect()}
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    assert set(got) == set(want)
    for c, turns_ in want.items():
        r = got[c]
        assert list(zip(r["roles"], r["texts"], strict=True)) == turns_ and r["positions_ok"]
        assert r["loss"] == "".join(x for role, x in turns_ if role == "assistant")
    emitted = sum(len(p["text"]) for p in packs.collect())
    assert emitted < sum(r["formatted_chars"] for r in got.values()) / 1.4  # shared turns once
    assert chat.pack(turns.where("false")).count() == 0


# ----------------------------------------------------------------- line dedup
def test_patience_aligns_in_order():
    a, b = [1, 2, 3, 9, 4, 5, 5], [7, 1, 2, 3, 4, 8, 5, 5]
    pairs = linedup.patience(a, b)
    assert pairs == sorted(pairs) and all(a[i] == b[j] for i, j in pairs)
    assert [a[i] for i, _ in pairs] == [1, 2, 3, 4, 5, 5]
    assert linedup.patience([], [1]) == [] and linedup.patience([1, 1], [1, 1]) == [(0, 0), (1, 1)]


def test_line_dedup(spark, odd, clashing, empty):
    block = "\n".join(f"this is shared line number {i} of the block" for i in range(4))
    rows = [(i, f"own start {i} a b c d\n{block}\nown end {i}", None, None, 1) for i in range(30)]
    rows += [(100, f"own\n{block.splitlines()[0]}\nother", None, None, 1)]  # below the least block
    out = {r["doc_id"]: r for r in linedup.deduplicated(frame(spark, rows).repartition(4)).collect()}
    assert out[0]["text"] == rows[0][1] and out[0]["dropped_lines"] == 0
    for i in range(1, 30):
        assert out[i]["text"] == f"own start {i} a b c d\nown end {i}" and out[i]["dropped_lines"] == 4
        assert out[i]["aligned_with"] == [0] and out[i]["n_chars"] == len(out[i]["text"])
    assert out[100]["dropped_lines"] == 0
    rows = linedup.deduplicated(odd).collect()
    got = defaultdict(set)
    for r in rows:
        got[r["doc_id"]].add(r["text"])
    assert len(rows) == odd.count() and got[1] == got[2] == {""} and got[3] == {None} and got[5] == {" \n\t "}
    assert linedup.deduplicated(clashing).count() == odd.count()
    assert linedup.deduplicated(empty).count() == 0


def test_line_dedup_moves_texts_alike_at_every_size(odd):
    """The join that cuts the texts does not turn from a broadcast to a shuffle as the table grows."""
    plan = linedup.deduplicated(odd)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_line_dedup_block_of_short_frequent_lines(spark):
    a, b = "the first line has seven words here", "and the other one has seven too"
    rows = [(0, f"{a}\nown zero", None, None, 1), (1, f"{b}\nown one", None, None, 1)]
    rows += [(i, f"own start {i}\n{a}\n\n{b}\nown end {i}", None, None, 1) for i in range(2, 22)]
    out = {r["doc_id"]: r for r in linedup.deduplicated(frame(spark, rows).repartition(4)).collect()}
    assert [out[i]["dropped_lines"] for i in range(3)] == [0, 0, 0]
    for i in range(3, 22):
        assert out[i]["text"] == f"own start {i}\nown end {i}" and out[i]["aligned_with"] == [2]


def held_before(texts, i):
    """Lines with a word of text i in a block of MIN_WORDS that an earlier text holds."""
    new, out = texts[i].split("\n"), set()
    for old in (t.split("\n") for t in texts[:i]):
        for s in range(len(new)):
            for p in range(len(old)):
                n = 0
                while s + n < len(new) and p + n < len(old) and new[s + n] == old[p + n]:
                    n += 1
                if sum(len(x.split()) for x in new[s:s + n]) >= linedup.MIN_WORDS:
                    out.update(x for x in range(s, s + n) if new[x].split())
    return out


def test_line_dedup_leaves_no_block(spark):
    rng = np.random.default_rng(5)
    pool = ["", " ", *(" ".join([f"w{i}"] * n) for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 13, 20]))]
    texts = ["\n".join(rng.choice(pool, rng.integers(1, 25))) for _ in range(120)]
    rows = [(i, t, None, None, 1) for i, t in enumerate(texts)]
    out = {r["doc_id"]: r["text"] for r in linedup.deduplicated(frame(spark, rows).repartition(4)).collect()}
    for i, t in enumerate(texts):
        lost = held_before(texts, i)
        want = [x for n, x in enumerate(t.split("\n")) if n not in lost and x.split()]
        assert [x for x in out[i].split("\n") if x.split()] == want


def test_line_dedup_of_shortened_documents(spark):
    """Lines of a document's own between the shared ones: those are left out of the pairs."""
    rng = np.random.default_rng(6)
    pool = ["", " ", *(" ".join([f"w{i}"] * n) for i, n in enumerate([1, 2, 3, 5, 6, 7, 9, 12, 13]))]
    texts = ["\n".join(f"own {i} {k} " + "x " * int(rng.integers(0, 14)) if rng.random() < 0.25 else str(rng.choice(pool))
                       for k in range(rng.integers(1, 30))) for i in range(90)]
    texts += texts[:5] + ["own 0\n" * 3]
    rows = [(i, t, None, None, 1) for i, t in enumerate(texts)]
    out = {r["doc_id"]: r["text"] for r in linedup.deduplicated(frame(spark, rows).repartition(4)).collect()}
    for i, t in enumerate(texts):
        lost = held_before(texts, i)
        want = [x for n, x in enumerate(t.split("\n")) if n not in lost and x.split()]
        assert [x for x in out[i].split("\n") if x.split()] == want


def test_line_dedup_shortens_to_long_shared_stretches():
    lines, words = np.arange(10, 18), np.array([3, 5, 4, 2, 0, 12, 9, 20], np.int32)
    h, w, at = linedup.shortened(lines, words, np.array([10, 11, 12, 15, 17]), 99)
    assert [x for x, n in zip(h, w, strict=True) if n >= 0] == [10, 11, 12, 14, 15, 17]
    assert w.tolist() == [-1, 3, 5, 4, -1, 0, 12, -1, 20] and len({*h.tolist()}) == 9
    assert [x for x, n in zip(at, w, strict=True) if n >= 0] == [0, 1, 2, 4, 5, 7]
    assert not any(len(x) for x in linedup.shortened(lines, words, np.array([10, 11, 13]), 99))


# ------------------------------------------------------------------- toxicity
def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit(docs, toxicity.training_labels(labels))
    rows = toxicity.scored(docs, model).join(labels, "doc_id").where("toxic IS NOT NULL").select(
        "doc_id", "toxic", "toxicity.score", "toxicity.starts").collect()
    rows = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    pos, neg = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    auc = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])
    assert auc > 0.75 and all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_odd_rows(spark, odd, clashing, empty):
    rows = [("What an idiot. Nice day.", 1, 1.0), ("Nice day and night.", 0, 1.0)] * 6
    model = toxicity.train(rows)
    got = defaultdict(set)
    for r in toxicity.scored(odd, model).collect():
        got[r["doc_id"]].add(r["toxicity"]["score"])
    assert got[3] == got[4] == got[5] == {0.0} and len(got[1]) == 1 and max(got[10]) > max(got[1])
    spans = {r["doc_id"]: (r["toxicity"]["starts"], r["toxicity"]["ends"]) for r in toxicity.scored(odd, model).collect()}
    assert spans[10][0][:1] == [0] and spans[10][1][:1] == [5]
    labels = spark.createDataFrame([(1, 0), (10, 1), (10, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert toxicity.clean_documents(clashing, labels).columns == clashing.columns
    assert toxicity.clean_documents(odd, labels.where("false")).count() == odd.count()
    assert toxicity.scored(empty, model).count() == 0


# --------------------------------------------------------------------- secrets
def test_secret_scan(spark, odd, empty):
    texts, label = [], {}
    for i in range(120):
        h = hashlib.sha1(str(i).encode()).hexdigest()
        texts.append((3 * i, f"the password={h[:18]} was set", None, None, 0))
        texts.append((3 * i + 1, f"call 4041894974{i:06d} or mail user{i}.x9@mail2.example.com today", None, None, 0))
        texts.append((3 * i + 2, f"the api_key: '{h[:24]}' and 10.20.30.{i}", None, None, 0))
    docs = frame(spark, texts)
    found = secretscan.findings(docs.unionByName(odd))
    rows = secretscan.classified(found, secretscan.weak_labels(found)).collect()
    held = [r for r in rows if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and r["weak"] is not None]
    assert len(held) > 50
    assert np.mean([r["is_secret"] == bool(r["weak"]) for r in held]) > 0.95
    assert secretscan.findings(empty).count() == 0
    none = secretscan.classified(found, secretscan.weak_labels(found).where("false")).collect()
    assert {r["probability"] for r in none} == {0.5}
    assert list(secretscan.runs("x 12 ab1 key=abcdefgh12. ")) == [(13, 23)]
    assert list(secretscan.runs("")) == [] and label == {}


def test_secret_candidates_of_any_characters():
    key = "AKIA" + "QWERTYUIOPASDFGH"
    for text, value in (("password=correcthorse now", "correcthorse"), ("the pwd: 'a!b#c$d%e' is", "a!b#c$d%e"),
                        ("secret = x1&y2*z3~q4:r5!, ok", "x1&y2*z3~q4:r5!"), (f"found {key}, twice", key),
                        ('{"api_key": "no-digits/here"}', "no-digits/here"), ("u?token=abcdefgh&user=bob", "abcdefgh"),
                        ("Authorization: Bearer abcDEFghi", "abcDEFghi"), ("passwd := `Ünïcode!`", "Ünïcode!")):
        assert [text[lo:hi] for lo, hi in secretscan.runs(text)] == [value], text
    assert list(secretscan.runs("the colour: red, a desk-top and 12:30")) == []
    assert secretscan.weak_label(key, "") == 1 and secretscan.weak_label("please", "password") is None


def test_secret_candidates_do_not_nest():
    for unit in ("token=a;", "token=", "sk-a;", "auth=?", "token=\"", "pwd=x,token=y&"):
        text = unit * ((1 << 20) // len(unit))
        assert sum(hi - lo for lo, hi in secretscan.runs(text)) <= 2 * len(text), unit
    given = "auth=https://h/p?token=abc123defg,pwd=zz;secret=q1"
    assert [given[lo:hi] for lo, hi in secretscan.given_values(given)] == ["https://h/p", "abc123defg", "zz", "q1"]


def test_secret_dictionary_has_every_frequent_word(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"q{letters[i % 26]}{letters[i // 26 % 26]}u{letters[i // 676 % 26]}{letters[i // 17576]}e" for i in range(25_000)]
    docs = frame(spark, [(i, " ".join(words), None, None, 0) for i in range(3)] + [(9, "zebra zürich zürich zürich", None, None, 0)])
    known, pairs = secretscan.dictionary(docs)
    assert all(w in known for w in words) and "zürich" in known and "zebra" not in known
    assert sum(f"x{w}" in known for w in words) < 10
    want = np.ones((27, 27))
    for w in words * 3 + ["zebra"] + ["zürich"] * 3:
        for a, b in zip(w, w[1:], strict=False):
            want[secretscan._letter(a), secretscan._letter(b)] += 1
    assert np.allclose(pairs, np.log(want / want.sum(axis=1, keepdims=True)))
    assert secretscan.covered("12zürich+zzz", known) == 0.5
    assert secretscan.weak_label("Zürich", "author", known) == 0


def test_winnow_short_texts_and_texts_without_blanks(spark):
    rng = np.random.default_rng(3)
    chinese = "".join(chr(0x4E00 + x) for x in rng.integers(0, 5000, 3000))
    few = "a short note of ten words for the near test"
    prose = " ".join(f"w{i}" for i in range(80))
    pairs = [(chinese, chinese[:2000] + "改" + chinese[2001:]), (few, few[:30] + "something else"), ("hello world", "hello worlds"),
             (f"{prose} {chinese}", f"changed {chinese[:2000]}😀{chinese[2001:]} {prose[::-1]}"), (few, few.replace(" ", " \n ")),
             (chinese, few)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    df = winnow.full_fingerprint(winnow.full_fingerprint(df, "a", "h", "p"), "b", "g", "q")
    rows = {r["i"]: r for r in df.withColumn("near", winnow.likeness("h", "g")).collect()}
    near = [rows[i]["near"] for i in range(len(pairs))]
    assert near[0] > 0.9 and near[1] > 0.3 and near[2] > 0.3 and near[3] > 0.9 and near[4] == 1 and near[5] == 0
    assert set(df.columns) == {"i", "a", "b", "h", "p", "g", "q"}
    assert all(len(r["h"]) == len(r["p"]) for r in rows.values())
    blank = winnow.full_fingerprint(spark.createDataFrame([(None,), ("",), (" \n",)], "t string"), "t", "h", "p").collect()
    assert all(r["h"] == r["p"] == [] for r in blank)
