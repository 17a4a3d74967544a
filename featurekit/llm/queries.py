"""The registered queries of the training-data operators, one per operator, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.llm import (
    chat,
    crosstok,
    decontam,
    jaccard,
    linedup,
    minhash,
    mixing,
    secretscan,
    sharding,
    strtree,
    tokenids,
    toxicity,
    winnow,
)
from featurekit.llm.common import read, utf8_bytes, written
from featurekit.session import fresh_dir

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out third of the ids."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, toxicity.training_labels(read(spark, sf_dir, "labels")))
    rows = toxicity.scored(docs, model)
    return rows.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                       F.col("toxicity.score").alias("score"),
                       (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                       F.size("toxicity.starts").alias("n_offending"),
                       F.col("toxicity.starts").alias("offending_starts"), F.col("toxicity.ends").alias("offending_ends"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, w[i:i + least(10, len(w)) - 1] AS win
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM k),
dw AS (SELECT doc_id, n, i, w[i:i + n - 1] AS win
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, k.item_id, dw.i, dw.n FROM dw JOIN k ON dw.n = k.n AND dw.win = k.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.w), 0) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items,
       sha256(coalesce(it.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)"""


@register("op2_decontamination", OP2_SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.annotate(docs, read(spark, sf_dir, "benchmark"))
    hit = F.aggregate(F.zip_with("leak.starts", "leak.ends", lambda a, b: b - a), F.lit(0).cast("long"),
                      lambda a, b: a + b)
    return found.select("doc_id", F.col("leak.n_words").alias("n_words"), hit.alias("n_hit"),
                        F.size("leak.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"),
                        (F.size("leak.starts") > 0).alias("contaminated"))


@register("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a 3:1:2 mix of 1.5 times the corpus takes of every document."""
    return mixing.taken_words(read(spark, sf_dir, "documents"))


#: Conversation -7: both of its texts look like an escaped control string.
TRAP = "\\### Assistant: </turn> ok"

OP4_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS body FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### : </turn>' || chr(10)) + length(role) + length(body)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@register("op4_chat", OP4_SQL)
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations packed as prefix trees, written, and read back."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], turns.schema)
    packs = written(chat.pack(turns.unionByName(trap)), "chat-packs")
    back = chat.unpack(packs)
    line = F.lit("\n")
    turns_ = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, line, t, line)), "")
    return back.select("conv_id", F.size("roles").cast("long").alias("n_turns"), F.sha2(turns_, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")


@register("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingles have a Jaccard similarity of 0.9."""
    return jaccard.components(read(spark, sf_dir, "documents"), n=3, percent=90)


@register("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the blocks they share with an earlier one."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return linedup.deduplicated(docs).select("doc_id", "dropped_lines", "aligned_with", "text")


@register("op7_token_ids")
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts as token ids, written as rANS blocks in doc_id order and read back."""
    import public_tokenizers

    folder = fresh_dir(spark, "token-ids")
    tokenids.write(read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenids.read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled, written as 16 shards and read back."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    back = sharding.write_shards(docs, fresh_dir(spark, "shards"), n_shards=16)
    text = F.coalesce("text", F.lit(""))
    return back.select("doc_id", (utf8_bytes(F.col("text")) + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                       "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of every document, of its edited text and of its neighbour."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = winnow.with_next(docs, ["text", "hashes", "parts"],
                            lambda d: winnow.full_fingerprint(d, "text", "hashes", "positions", "parts"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")),
        F.substring("next_text", F.lit(1), cut)))
    rows = rows.withColumn("near_next", winnow.likeness_by_parts("hashes", "parts", "next_hashes", "next_parts"))
    rows = winnow.full_fingerprint(rows.drop("next_text", "next_hashes", "next_parts", "text"),
                                   "edited", "edited_hashes", "edited_positions", "edited_parts")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       winnow.as_string("hashes", "positions").alias("fingerprint"),
                       winnow.as_string("edited_hashes", "edited_positions").alias("edited_fingerprint"),
                       winnow.likeness_by_parts("hashes", "parts", "edited_hashes", "edited_parts").alias("near_edited"),
                       "near_next")


@register("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for secrets in every document, and which of them are."""
    found = secretscan.findings(read(spark, sf_dir, "documents"))
    rows = secretscan.classified(found, secretscan.weak_labels(found))
    return rows.select("doc_id", "start", "end", "name", "sha256", F.col("weak").alias("form_label"),
                       toxicity.held_out(F.col("doc_id")).alias("held_out"),
                       F.round("probability", 6).alias("probability"), "is_secret")


OP11_SQL = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""


@register("op11_hard_negatives", OP11_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, among all of them."""
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return strtree.hard_negatives(rows.select("vec_id", label.alias("label"), F.col("embedding").alias("vector")))


@register("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizers' ids of all texts aligned by their bytes, and how often the aligned ids are linked."""
    import public_tokenizers

    return crosstok.document_alignment(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                       public_tokenizers.path("piece_bpe_32k.model"))


@register("op13_minhash")
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 4-word shingles have a Jaccard similarity of 0.8, found by MinHash."""
    return minhash.components(read(spark, sf_dir, "documents"), n=4, percent=80)
