"""Alignment of two tokenizers over the same bytes.

A text with a blank before it is encoded by a byte-level BPE of the tokenizers library (A), and the
text itself by a sentencepiece model (B, which adds that blank). Where tokens of A and of B end at the
same byte the text is cut into groups; every token of A in a group is linked with every one of B in it.

Byte offsets. Coarse cuts are A's character offsets and the byte spans of B's proto (the installed
sentencepiece calls its immutable proto ``proto``). They hold for tokens of whole characters. Where
neighbouring tokens share a character (A), or spans are empty (B's byte fallback), the cuts within are
refined with the lengths of the tokens' decoded bytes. The tokens' joined bytes are compared with the text's.

Stretches. Neither tokenizer has a token across the border of a visible character and white space, nor of a letter
or digit and an ASCII punctuation mark other than the apostrophe: A's pre-tokeniser cuts there, and that no piece of
B crosses it is checked when B is loaded (characters and white space that some piece has across it, as a carriage return, are left together). So a
text is cut there, every distinct stretch is aligned once and remembered in a bounded cache, and a text's
alignment is that of its stretches in order.

Corpus counts. Documents are dealt to chunks of bounded size. A chunk's row holds its distinct id pairs, in how
many of its documents each is linked, and every document's pairs as places in that list. The
pairs are counted over all chunks, joined back to the chunks' pairs, and summed per document where the
chunk lies. What is shuffled is the chunks' distinct pairs, never the documents' links.

Defined results: null and empty texts, and texts whose joined bytes differ from the text's under A or B
(a literal U+2581 becomes a blank), have no tokens: zeros and no groups. Special tokens' strings are plain
text. Equal rows, and rows without a doc_id, count as documents of their own; an empty table gives no rows;
other columns are left aside.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import written
from featurekit.session import ship_package

#: Documents and bytes of text of a chunk (a longer text is a chunk of its own).
CHUNK_DOCS, CHUNK_BYTES = 500, 2 << 20
#: Stretches that a worker remembers before it forgets the rarer ones, their characters and their groups', and
#: stretches aligned at a time.
CACHE, CACHE_CHARS, LEARN = 500_000, 64_000_000, 20_000
_BLANK = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>\Z")
#: Marks before which a stretch may begin (as a class of regular expressions), and the stretches of a text.
_MARK = r"!-&(-/:-@\[-`{-~"
_STRETCH = re.compile(rf"\s*[{_MARK}]*[^\s{_MARK}]*")
_OPEN = re.compile(rf"[^\s{_MARK}]\Z")
#: White space of Python's that is none to A's pre-tokeniser.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Columns of a stretch's numbers; bytes equal: 1 where the tokens' bytes are the stretch's.
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "bytes equal", "first pair")


def _byte_alphabet() -> dict[str, int]:
    """Character of the byte-level alphabet to its byte: printable bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Alignments of texts, by their stretches."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = _byte_alphabet()
        self.bytes_a = {i: bytes(of[c] for c in t) if all(c in of for c in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_b, pieces = [], [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for i, p in enumerate(pieces):
            m = _BYTE.match(p) if self.b.is_byte(i) else None
            self.bytes_b.append(bytes([int(m[1], 16)]) if m else p.replace(_BLANK, " ").encode())
        pieces = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any(re.search(r"\S[ \n]", p.replace(_BLANK, " ")) for p in pieces):
            raise ValueError("a piece holds a blank or line feed after another sign: texts cannot be cut there")
        #: white space that a token may hold after a visible character, and characters before marks
        self.glue = {*_SEPARATORS, *(c for p in pieces for c in re.findall(r"\S(\s)", p))}
        self.crossing = {c for p in pieces for c in re.findall(rf"([^\s{_MARK}])[{_MARK}]", p.replace(_BLANK, " "))}
        self.size_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(max(self.bytes_a) + 1)], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        ids = max(len(self.size_a), len(self.size_b))
        self.decimal = [f"{i}{x}" for i in range(ids) for x in ",|,;"]
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}  # a stretch to its number
        self.chars, self.groups, self.open = 0, [], []
        self.uses = np.zeros(1 << 12, np.int64)  # chunks that have held the stretch
        self.numbers = np.zeros((1 << 12, len(_NUMBERS)), np.int64)
        self.pairs = np.zeros(1 << 14, np.int64)  # the linked id pairs of all stretches, a * 2^32 + b
        self.used = 0

    def forget_rare(self) -> None:
        """Keeps the stretches of two chunks or more; if these are over half the cache, of more."""
        stretches, groups, open_, numbers, pairs = list(self.at), self.groups, self.open, self.numbers, self.pairs
        uses, least = self.uses[:len(groups)], 2
        while (uses >= least).sum() > CACHE // 2:
            least *= 2
        kept = np.flatnonzero(uses >= least)
        numbers, uses = numbers[kept], uses[kept]
        self.forget()
        if self.kept_chars(stretches, groups, kept) > CACHE_CHARS // 2:
            return
        self.at = {stretches[i]: k for k, i in enumerate(kept.tolist())}
        self.groups, self.open = [groups[i] for i in kept.tolist()], [open_[i] for i in kept.tolist()]
        self.chars = self.kept_chars(stretches, groups, kept)
        self.pairs = pairs[_ranges(numbers[:, 5], numbers[:, 3])]
        self.used, numbers[:, 5] = len(self.pairs), np.cumsum(numbers[:, 3]) - numbers[:, 3]
        self.pairs = np.append(self.pairs, np.zeros(1 << 14, np.int64))
        self.numbers = np.concatenate([numbers, np.zeros_like(self.numbers)])
        self.uses = np.append(uses, np.zeros(len(self.uses), np.int64))

    @staticmethod
    def kept_chars(stretches: list[str], groups: list[str], kept: np.ndarray) -> int:
        return sum(len(stretches[i]) + len(groups[i]) for i in kept.tolist())

    def encoded(self, new: list[str]):
        """Of stretches, one after another: (ids, byte ends in the stretches' joined
        bytes, tokens of each stretch) under A and B, the stretches' byte ends, and which equal their tokens' bytes."""
        x = self.a.encode(new, is_pretokenized=True, add_special_tokens=False)
        # a line feed, always a token of its own, parts each stretch from the blank that B puts first
        y = [p.pieces[2:] for p in self.b.encode(["\n" + s for s in new], return_type="proto", num_threads=1)]
        raw, joined = [s.encode() for s in new], "".join(new)
        stop = np.cumsum([len(r) for r in raw])
        start = stop - [len(r) for r in raw]
        # under A: character offsets, which tokens of one character share
        word = np.array(x.word_ids, np.int64)
        chars = np.cumsum([len(s) for s in new])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
        spans = np.fromiter(chain.from_iterable(x.offsets), np.int64).reshape(-1, 2) + (chars - [len(s) for s in new])[word, None]
        ids_a = np.array(x.ids, np.int64)
        ends_a = _refined(at[spans[:, 1]], np.append(spans[1:, 0] < spans[:-1, 1], False), self.size_a[ids_a], word, start)
        # under B: byte spans after that line feed, empty ones before the last byte of a character
        n_b = np.array([len(p) for p in y], np.int64)
        of = np.repeat(np.arange(len(new)), n_b)
        flat = np.fromiter((v for p in y for t in p for v in (t.id, t.begin, t.end)), np.int64).reshape(-1, 3)
        ids_b = flat[:, 0]
        ends_b = _refined(flat[:, 2] - 1 + start[of], flat[:, 1] == flat[:, 2], self.size_b[ids_b], of, start)
        n_a = np.bincount(word, minlength=len(new))
        ok = np.ones(len(new), bool)
        for ids, n, table in ((ids_a, n_a, self.bytes_a), (ids_b, n_b, self.bytes_b)):
            got, to = [table[i] for i in ids.tolist()], np.cumsum(n).tolist()
            if b"".join(got) != b"".join(raw) or any(map(int.__ne__, np.add.reduceat(
                    [*map(len, got), 0], np.cumsum(n) - n).tolist(), map(len, raw))):
                ok &= [b"".join(got[t - k:t]) == r for t, k, r in zip(to, n.tolist(), raw, strict=True)]
        return (ids_a, ends_a, n_a), (ids_b, ends_b, n_b), stop, ok

    def learn(self, new: list[str]) -> None:
        for lo in range(0, len(new), LEARN):
            self._learn(new[lo:lo + LEARN])

    def _learn(self, new: list[str]) -> None:
        (a, ends_a, n_a), (b, ends_b, n_b), stop, ok = self.encoded(new)
        fine = np.repeat(ok, n_a), np.repeat(ok, n_b)
        (a, ends_a), (b, ends_b) = ((x[f], e[f]) for x, e, f in ((a, ends_a, fine[0]), (b, ends_b, fine[1])))
        cuts = np.intersect1d(ends_a, ends_b)
        in_a, in_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        per_a, per_b = np.bincount(in_a, minlength=len(cuts)), np.bincount(in_b, minlength=len(cuts))
        stretch = np.searchsorted(stop, cuts)  # of each group
        # every token of A with the tokens of B in its group
        reps = per_b[in_a]
        first = (np.cumsum(per_b) - per_b)[in_a]
        other = np.repeat(first - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
        pairs = (np.repeat(a, reps) << 32) | b[other]
        # the groups in decimal: a token's text and what follows it
        side = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
        group = np.concatenate([in_a, in_b])
        order = np.argsort(2 * group + side, kind="stable")
        last = np.append(np.diff((2 * group + side)[order]) != 0, True)[:len(order)]
        text = [self.decimal[k] for k in (4 * np.concatenate([a, b])[order] + 2 * side[order] + last).tolist()]
        n_groups = np.bincount(stretch, minlength=len(new))
        links = np.bincount(stretch, per_a * per_b, len(new)).astype(np.int64)
        to = np.cumsum(np.where(ok, n_a + n_b, 0)).tolist()
        base, at = len(self.groups), 0
        for s, end in zip(new, to, strict=True):
            self.at[s] = len(self.groups)
            self.groups.append("".join(text[at:end]))
            self.open.append(self.unfinished(s))
            self.chars += len(s) + len(self.groups[-1])
            at = end
        while base + len(new) > len(self.numbers):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.uses = np.append(self.uses, np.zeros(len(self.numbers) - len(self.uses), np.int64))
        while self.used + len(pairs) > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        self.numbers[base:base + len(new)] = np.stack(
            [n_a, n_b, n_groups, links, ok, self.used + np.cumsum(links) - links], axis=1)
        self.pairs[self.used:self.used + len(pairs)] = pairs
        self.used += len(pairs)

    def unfinished(self, stretch: str) -> bool:
        """Whether what follows a stretch may belong to it: a token might cross to a mark, or it
        holds white space that may stand inside a token."""
        last = stretch[-1:]
        return bool(_OPEN.search(stretch)) and (not last.isalnum() or last in self.crossing) or any(
            c in stretch for c in self.glue)

    def stretches(self, text: str) -> list[str]:
        """The stretches of a text with a blank before it; where one may belong to the next, they are one."""
        out, join = [], False
        for s in _STRETCH.findall(" " + text)[:-1]:  # the last match is empty
            if join and not s[0].isspace() or s[0] in self.glue or out and out[-1][-1] in self.glue:
                out[-1] += s
            else:
                out.append(s)
            join = self.unfinished(out[-1])
        return out

    def codes(self, texts: list[str]) -> list[list[int]]:
        """The numbers of each text's stretches, which are aligned where they are new."""
        if self.chars > CACHE_CHARS or len(self.groups) > CACHE:
            self.forget_rare()
        parts = [_STRETCH.findall(" " + t)[:-1] for t in texts]
        at = self.at
        self.learn(list({s for p in parts for s in p if s not in at}))
        out = [list(map(at.__getitem__, p)) for p in parts]
        for k, codes in enumerate(out):
            if any(map(self.open.__getitem__, codes)):
                p = self.stretches(texts[k])
                self.learn(list({s for s in p if s not in at}))
                out[k] = list(map(at.__getitem__, p))
        return out

    def text(self, text: str):
        """Ids and byte ends of a whole text (a blank first) under A and B, and the cuts (the groups' byte ends)."""
        if not text:
            return [], [], [], [], []
        (a, ends_a, _), (b, ends_b, _), _, ok = self.encoded(self.stretches(text))
        return (a, ends_a, b, ends_b, np.intersect1d(ends_a, ends_b)) if ok.all() else ([], [], [], [], [])


def _refined(coarse: np.ndarray, shared: np.ndarray, size: np.ndarray, of: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The tokens' byte ends: coarse cuts, but within a character the decoded bytes of the stretch's tokens so far."""
    so_far = np.cumsum(size)
    before = so_far - size
    first = np.searchsorted(of, np.arange(len(start)))
    base = np.append(before, 0)[first]
    return np.where(shared, so_far - base[of] + start[of], coarse)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


_CHUNK = pa.schema([
    ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
    ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("sha256", pa.list_(pa.string())),
    ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.int64())), ("places", pa.binary()),
    ("times", pa.binary())])
CHUNK = ("chunk long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
         "sha256 array<string>, pairs array<long>, docs array<long>, held array<long>, places binary, times binary")


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 4 * n, "zstd", asbytes=True) if n else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _chunk(aligner: Aligner, number: int, ids: list, texts: list[str]) -> pa.RecordBatch:
    codes = aligner.codes(texts)
    n, none = len(texts), np.zeros(0, np.int64)
    flat = np.fromiter((c for x in codes for c in x), np.int64)
    doc = np.repeat(np.arange(n), [len(x) for x in codes])
    has = np.array([bool(t) for t in texts], bool)
    has[doc[aligner.numbers[flat, 4] == 0]] = False
    sums = np.stack([np.bincount(doc, aligner.numbers[flat, k], n).astype(np.int64) * has for k in range(4)], axis=1)
    sha = [hashlib.sha256("".join(map(aligner.groups.__getitem__, x))[:-1].encode()).hexdigest() if h else ""
           for x, h in zip(codes, has.tolist(), strict=True)]
    keep = has[doc]
    used, flat = np.unique(flat[keep], return_inverse=True)
    aligner.uses[used] += 1
    key, mult = np.unique(doc[keep] * max(1, len(used)) + flat, return_counts=True)
    doc, code = np.divmod(key, max(1, len(used)))
    # the stretches' pairs as places in the chunk's distinct ones
    n_links = aligner.numbers[used, 3]
    pairs, place = np.unique(aligner.pairs[_ranges(aligner.numbers[used, 5], n_links)], return_inverse=True)
    reps = n_links[code]
    at = _ranges((np.cumsum(n_links) - n_links)[code], reps)
    key = np.repeat(doc, reps) * max(1, len(pairs)) + place[at]
    order = np.argsort(key, kind="stable")
    key, often = key[order], np.repeat(mult, reps)[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    doc, place = np.divmod(key[first], max(1, len(pairs)))
    often = np.add.reduceat(often, first) if len(first) else none
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip([
        number, ids, *sums.T, sha, pairs, np.bincount(place, minlength=len(pairs)), np.bincount(doc, minlength=n),
        _packed(place), _packed(often)], _CHUNK, strict=True)], schema=_CHUNK)


def _chunk_rows(paths: tuple[str, str]):
    def rows(batches):
        aligner, number = _aligner(paths), TaskContext.get().partitionId() << 33
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t or "")
                size += len(texts[-1])
                if len(ids) >= CHUNK_DOCS or size >= CHUNK_BYTES:
                    yield _chunk(aligner, number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield _chunk(aligner, number, ids, texts)
    return rows


DOCUMENT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
_DOCUMENT = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DOCUMENT.split(", ")])


def _document_rows(batches):
    """Rows of chunks with the corpus counts of their pairs: a row per document."""
    for b in batches:
        for r in range(b.num_rows):
            c = {f: b.column(f)[r] for f in b.schema.names}
            held = np.array(c["held"].as_py(), np.int64)
            place, often = _unpacked(c["places"].as_py(), int(held.sum())), _unpacked(c["times"].as_py(), int(held.sum()))
            count, best = np.zeros(len(c["pairs"]) + 1, np.int64), np.zeros(len(c["pairs"]) + 1, np.int64)
            known = c["known"].values
            if known is not None:
                at = np.asarray(known.field("pos"), np.int64)
                count[at], best[at] = np.asarray(known.field("n"), np.int64), np.asarray(known.field("best"), np.int64)
            doc = np.repeat(np.arange(len(held)), held)
            sums = [np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)]
            np.add.at(sums[0], doc, often * best[place])
            np.add.at(sums[1], doc, often * count[place])
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(
                [c["doc_ids"].as_py(), *(c[f].as_py() for f in ("n_a", "n_b", "n_groups", "n_links")), *sums,
                 c["sha256"].as_py()], _DOCUMENT, strict=True)], schema=_DOCUMENT)


def chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The documents' alignments by chunk (``CHUNK``), written."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(docs.mapInArrow(_chunk_rows((path_a, path_b)), CHUNK), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): ids linked in n documents; whether no other b is linked with a in more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(
        F.sum("x.docs").alias("n"))
    each = written(each.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"),
                               "pair", "n"), "pair-counts")
    most = each.groupBy("a").agg(F.max("n").alias("most"))
    return each.join(most, "a").select("a", "b", "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def document_alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document (``DOCUMENT``): tokens, groups and links; links that are their A id's most
    frequent, and the links' counts summed."""
    aligned = chunks(docs, path_a, path_b)
    counts = pair_counts(aligned).select("pair", "n", F.col("best").cast("int").alias("best"))
    known = aligned.select("chunk", F.posexplode("pairs").alias("pos", "pair")).join(counts, "pair").groupBy("chunk").agg(
        F.collect_list(F.struct("pos", "n", "best")).alias("known"))  # a chunk's distinct pairs
    return aligned.drop("docs").join(known, "chunk", "left").select(
        "doc_ids", "n_a", "n_b", "n_groups", "n_links", "sha256", "pairs", "held", "places", "times", "known").mapInArrow(
        _document_rows, DOCUMENT)


def token_spans(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document: ids and byte ends of its tokens under A and B (of blank + text), and the groups' ends."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.list_(pa.int64())) for c in (
        "a_ids", "a_ends", "b_ids", "b_ends", "cuts"))])

    def rows(batches):
        aligner = _aligner((path_a, path_b))
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(
                    [i, *aligner.text(t or "")], schema, strict=True)], schema=schema)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        rows, "doc_id long, a_ids array<long>, a_ends array<long>, b_ids array<long>, b_ends array<long>, cuts array<long>")
