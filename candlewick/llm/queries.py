"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import quality, toxicity
from candlewick.llm.common import fold, table
from candlewick.llm.decontaminate import decontaminate
from candlewick.llm.fill_middle import fill_in_middle, restore
from candlewick.llm.hard_negatives import mine
from candlewick.llm.license_scan import scan_licenses
from candlewick.llm.lm_score import score_documents
from candlewick.llm.sentencepiece_codec import encode_checked, n_tokens
from candlewick.llm.sharding import shard_documents
from candlewick.llm.simhash import hex16, near_duplicates
from candlewick.llm.token_count import count_tokens
from candlewick.llm.topk import build_index, top_k
from candlewick.llm.warc import page_id_of, read_warc, write_warc

SHARDS = 40
QUERY_EVERY, TOP = 50, 5
TOKEN_LIMIT = 512
ANCHOR_EVERY = 100
TOXIC = 0.7


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (never copied into the repository)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("contamination")
    return decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                         table(spark, sf_dir, "benchmark")).select(
        "doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), c["n_items"].alias("n_items"),
        F.sha2(F.array_join(c["items"], ",").cast("binary"), 256).alias("items_sha256"),
        c["contaminated"].alias("contaminated"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fold("doc_id", 5) != 1).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.where(F.col("vec_id") % QUERY_EVERY == 0)
    return top_k(build_index(vectors, "vec_id", "embedding"), queries, "vec_id", "embedding", TOP)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_warc(write_warc(table(spark, sf_dir, "pages")))
    return records.select(
        page_id_of("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_id_of("refers_to").cast("long").alias("refers_to"))


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _labelled(spark, sf_dir)
    held = fold("doc_id", 3) == 1
    model = quality.fit(docs, labels, ~held)
    return quality.score(docs, model, out="score").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _labelled(spark, sf_dir)
    held = fold("doc_id", 3) == 1
    model = toxicity.fit(docs, labels, ~held)
    return toxicity.score(docs, model, out="score").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer_path("byte_bpe_50k.json")).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    e = F.col("encoded")
    return encode_checked(docs, tokenizer_path("piece_bpe_32k.model")).select(
        "doc_id", n_tokens(e["ids"]).alias("n_tokens"), e["ids"].alias("ids"),
        e["round_trip"].alias("round_trip"), e["parity"].alias("parity"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", hex16(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _sha256(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    return restore(cut, F.col("output"), F.col("form")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", _sha256("output").alias("output_sha256"),
        _sha256("restored").alias("restored_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(vectors, F.col("vec_id") % ANCHOR_EVERY == 0)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("license")
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *[x[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join(x["base_labels"], ",").alias("base_labels"), F.array_join(x["labels"], ",").alias("labels"),
        x["score"].alias("score"), F.size(x["spans"]).alias("n_spans"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_lm_score": op2_lm_score,
    "op3_topk": op3_topk,
    "op4_warc": op4_warc,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_simhash": op9_simhash,
    "op10_sharding": op10_sharding,
    "op11_fill_middle": op11_fill_middle,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_license_scan": op13_license_scan,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: The other queries have no SQL form: DuckDB has neither XXH64 nor CRC-32 nor
#: the tokenizers, the classifiers are fitted, and sums of thousands of
#: logarithms have no fixed last digits to hash.  Their tests hold them against
#: brute force, exact round trips or held-out labels.
SQL: dict[str, str] = {
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
pos AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d CROSS JOIN (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT doc_id, i, n, item_id FROM pos JOIN win USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op3_topk": f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM s QUALIFY rank <= {TOP}""",
    "op4_warc": """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
l AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to FROM l""",
    "op11_fill_middle": """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
r AS (SELECT doc_id, t, n, CAST('0x' || s[1:8] AS BIGINT) % (n + 1) AS x, CAST('0x' || s[9:16] AS BIGINT) % (n + 1) AS y,
    CAST('0x' || s[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || s[25:32] AS BIGINT) % 100 AS h4 FROM h),
c AS (SELECT doc_id, t, n, least(x, y) AS a, greatest(x, y) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
         WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars, sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN substring(output, 4, strpos(output, '<S>') - 4) || substring(output, strpos(output, '<M>') + 3)
      || substring(output, strpos(output, '<S>') + 3, strpos(output, '<M>') - strpos(output, '<S>') - 3)
    ELSE substring(output, strpos(output, '<P>') + 3, strpos(output, '<M>') - strpos(output, '<P>') - 3)
      || substring(output, strpos(output, '<M>') + 3) || substring(output, 4, strpos(output, '<P>') - 4)
    END) AS restored_sha256
FROM o""",
    "op12_hard_negatives": f"""
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10""",
}
