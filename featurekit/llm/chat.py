r"""Chat formatting as a packed prefix tree.

A turn is written ``### <role>: <text></turn>\n``. In roles and texts a backslash stands
before every backslash and before every control string (``###`` and ``</turn>``; in
roles also before each colon and line break), so a text can hold any control string and
is read back exactly.

Conversations are sorted by the hashes of their turn prefixes, which puts those with
the same first turns side by side, and each task walks its sorted rows once: a turn that
the previous conversation shares is already on the stack, any other is emitted. The
emitted turns are thus in depth-first order and each is emitted once per pack. A pack
ends at ``PACK_CHARS`` characters or ``PACK_CONVS`` conversations; the next one emits the
shared turns anew, so neither a hot first turn nor a hot conversation (copies are
spread by conv_id) gathers in one task, row or pack.

A token is a code point. A pack is one row: ``text`` (the emitted turns), ``nodes`` (per
turn: start and end in the text, the position id of its first token, parent node, loss
span start and end, and whether it holds loss) and ``convs`` (conv_id, its last node).
Position ids run on from the parent's last token. A token may attend to its own node's
earlier tokens and to its ancestors' whole spans: ``attention`` gives a node's ancestor
intervals, [start, end) in the pack, merged where they touch.

Defined results: null roles and texts are empty strings; turns are ordered by turn
(null first), then role, then text, equal rows are turns of their own; a null conv_id is
one conversation; an empty table gives no packs; further columns are left aside. One
conversation is one text and must fit a task.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.session import ship_package

PACK_CHARS = 1 << 17
PACK_CONVS = 512
TURN, END = "### ", "</turn>\n"

_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:|\n")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:|\n)")
_FORMATTED = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)

PACKS = ("text string, nodes array<struct<start:int,end:int,position:int,parent:int,loss_start:int,loss_end:int,"
         "loss:boolean,attention:array<struct<start:int,end:int>>>>, convs array<struct<conv_id:bigint,node:int>>")


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group(1), text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(turn as written, start and end of its text in it)."""
    head = f"{TURN}{escape(role, _ROLE_CONTROL)}: "
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _FORMATTED.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(m.group(1)), unescape(m.group(2))))
        at = m.end()
    return out


def _packer(batches):
    """Walks conversations sorted by path; yields packs."""
    nodes, convs, texts, size = [], [], [], 0
    path: list[tuple[str, int]] = []  # (turn hash, node) from the root

    def pack():
        return pd.DataFrame([("".join(texts), nodes, convs)], columns=["text", "nodes", "convs"])

    for pdf in batches:
        for conv, keys, turns in zip(pdf["conv_id"], pdf["path"], pdf["turns"], strict=True):
            steps = [keys[i:i + 16] for i in range(0, len(keys), 16)]
            if size >= PACK_CHARS or len(convs) >= PACK_CONVS:
                yield pack()
                nodes, convs, texts, size, path = [], [], [], 0, []
            shared = 0
            while shared < min(len(path), len(steps)) and path[shared][0] == steps[shared]:
                shared += 1
            path = path[:shared]
            for key, turn in zip(steps[shared:], turns[shared:], strict=True):
                written, lo, hi = format_turn(turn["role"], turn["text"])
                parent = path[-1][1] if path else -1
                position, attention = 0, []
                if path:
                    p = nodes[parent]
                    position = p["position"] + p["end"] - p["start"]
                    attention = [dict(a) for a in p["attention"]]
                    if attention and attention[-1]["end"] == p["start"]:
                        attention[-1]["end"] = p["end"]
                    else:
                        attention.append({"start": p["start"], "end": p["end"]})
                nodes.append({"start": size, "end": size + len(written), "position": position, "parent": parent,
                              "loss_start": size + lo, "loss_end": size + hi, "loss": turn["role"] == "assistant",
                              "attention": attention})
                texts.append(written)
                size += len(written)
                path.append((key, len(nodes) - 1))
            convs.append({"conv_id": None if pd.isna(conv) else int(conv), "node": path[-1][1]})
    if convs:
        yield pack()


def _paths(turns: pd.Series) -> pd.Series:
    """16 hex characters per turn: the hash of the conversation up to it."""
    out = []
    for rows in turns:
        h, key = hashlib.blake2b(digest_size=8), []
        for r in rows:
            for s in (r["role"], r["text"]):
                b = s.encode("utf-8", "surrogatepass")
                h.update(len(b).to_bytes(8, "little") + b)
            key.append(h.hexdigest())
        out.append("".join(key))
    return pd.Series(out)


def pack(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """Packs of all conversations in ``turns`` (conv_id, turn, role, text)."""
    spark = turns.sparkSession
    ship_package(spark)
    text, role = (F.coalesce(c, F.lit("")).alias(c) for c in ("text", "role"))
    convs = (turns.select("conv_id", "turn", role, text)
             .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")))
    convs = convs.withColumn("path", F.pandas_udf(_paths, "string")("turns"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (convs.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
            .mapInPandas(_packer, PACKS))


def _read_back(batches):
    for pdf in batches:
        rows = []
        for text, nodes, convs in zip(pdf["text"], pdf["nodes"], pdf["convs"], strict=True):
            known: dict[int, tuple] = {}  # copies end in the same node
            for c in convs:
                if c["node"] not in known:
                    known[c["node"]] = _conversation(text, nodes, c["node"])
                rows.append((c["conv_id"], *known[c["node"]]))
        out = pd.DataFrame(rows, columns=["conv_id", "roles", "texts", "loss", "formatted_chars", "positions_ok"])
        out["conv_id"] = out["conv_id"].astype("Int64")
        yield out


def _conversation(text: str, nodes, last: int) -> tuple:
    """What the last node's tokens can attend to, read as a conversation; the loss text of
    its nodes, in order."""
    own = nodes[last]
    spans = [(a["start"], a["end"]) for a in own["attention"]] + [(own["start"], own["end"])]
    formatted = "".join(text[a:b] for a, b in spans)
    chain, at = [], last
    while at >= 0:
        chain.append(nodes[at])
        at = nodes[at]["parent"]
    chain.reverse()
    loss = [unescape(text[c["loss_start"]:c["loss_end"]]) for c in chain if c["loss"]]
    lengths = np.cumsum([0] + [c["end"] - c["start"] for c in chain])
    ok = [c["position"] for c in chain] == lengths[:-1].tolist() and lengths[-1] == len(formatted)
    turns = parse(formatted)
    return [r for r, _ in turns], [t for _, t in turns], "".join(loss), len(formatted), ok


def unpack(packs: DataFrame) -> DataFrame:
    """(conv_id, roles, texts, loss, formatted_chars, positions_ok) of every conversation,
    read from packs."""
    ship_package(packs.sparkSession)
    return packs.mapInPandas(_read_back, "conv_id long, roles array<string>, texts array<string>, loss string, "
                                         "formatted_chars long, positions_ok boolean")
