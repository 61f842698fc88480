"""The registered queries of this subpackage and, where SQL can express them,
their DuckDB SQL.  Each query applies its operator to its whole tables with
production parameters and derives the digest columns from the operator's
output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiframe.llm import (binary_codes, conversations, decontam, jaccard, mixing, ngram_lm, quality, runs, secrets, sharding,
                           token_files, toxicity, warc_zip)
from equiframe.llm.shared import ship_package


def _table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    """Path of the public word-level BPE file, and the id that ends documents."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


END_ID = 1


def op1_warc_zip(spark, sf_dir):
    """WARC records of all pages in ZIP packages, read back by ranges."""
    path = warc_zip.write(_table(spark, sf_dir, "pages"))
    return warc_zip.read(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_mixing(spark, sf_dir):
    """All documents mixed to their sources' target weights."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark, sf_dir):
    """Expected severity of all documents, learnt from ``labels``."""
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality_rules(spark, sf_dir):
    """Base counts, distances to the language references and verdict."""
    return quality.score(_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark, sf_dir):
    """Secrets of all documents, those in decoded layers included."""
    found = secrets.find(_table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def text(name):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", *map(count, secrets.KINDS), F.sha2(text("base"), 256).alias("base_sha256"),
                        text("spans").alias("spans"))


def op6_ngram_jaccard(spark, sf_dir):
    """Linked components of all documents by shingle Jaccard."""
    return jaccard.join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_decontamination(spark, sf_dir):
    """Benchmark windows in all documents."""
    found = decontam.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op8_token_files(spark, sf_dir):
    """All documents as token files, read back."""
    return token_files.read(spark, token_files.write(_table(spark, sf_dir, "documents"), word_tokenizer(), END_ID))


def op9_sharding(spark, sf_dir):
    """All documents in shards of near equal bytes."""
    return sharding.shard(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_lm_scoring(spark, sf_dir):
    """Log10 probability of all documents under an n-gram trie."""
    return ngram_lm.score(_table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` where every tenth text repeats some of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def planted(words):
        n = F.size(words)
        a = F.pmod(g, n.cast("long"))
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("long")
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(
            F.get(words, (a + F.pmod(i - a, p)).cast("int")))), " ")

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    hit = F.coalesce(F.pmod(h, F.lit(10)) == 0, F.lit(False)) & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return docs.withColumn("text", F.when(hit, F.get(F.transform(F.array(words), planted), F.lit(0))).otherwise(F.col("text")))


def op11_run_detection(spark, sf_dir):
    """Runs of repeating words in all documents, some of them planted."""
    found = runs.find(with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults, by a checksum of conversation and turn."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return rows.withColumn("kind", kind).filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(text("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
        .alias("text"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def op12_conversation_repair(spark, sf_dir):
    """Faults and cheapest repairs of all conversations, after damage."""
    rows = _table(spark, sf_dir, "conversations")
    repair = conversations.Repair(damaged(rows).drop("copy"))
    every = rows.select("conv_id").distinct().withColumn("conv", conversations.conversation_key())
    made = repair.faults.join(repair.cost_and_audit(), "conv").join(conversations.repaired_hash(repair.turns()), "conv", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(made, "conv", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_binary_codes(spark, sf_dir):
    """Links and components of all embeddings within their labels."""
    return binary_codes.link(_table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


Q = {f.__name__: f for f in (op1_warc_zip, op2_mixing, op3_toxicity, op4_quality_rules, op5_secret_scan,
                             op6_ngram_jaccard, op7_decontamination, op8_token_files, op9_sharding, op10_lm_scoring, op11_run_detection,
                             op12_conversation_repair, op13_binary_codes)}

_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(length(text), 0) AS chars FROM documents),
k AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE)
             / 4503599627370496.0::DOUBLE)
         / CASE WHEN chars / greatest(size, 1)::DOUBLE BETWEEN 3 AND 10 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS key FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM k GROUP BY source),
r AS (
  SELECT *, row_number() OVER w AS rn, sum(3 * source_size) OVER w AS held, sum(weight) OVER w AS used,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST)),
c AS (  -- sharing what the k sources that fill up first leave
  SELECT 0 AS k, max(total)::DOUBLE / max(weights)::DOUBLE AS share FROM r
  UNION ALL
  SELECT rn, (total - held)::DOUBLE / (weights - used)::DOUBLE FROM r WHERE weights > used),
l AS (
  SELECT share FROM c WHERE NOT EXISTS (
    SELECT 1 FROM r WHERE r.rn = c.k + 1 AND c.share * r.weight > 3 * r.source_size) ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN share * weight > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE share * weight END AS target
  FROM s, l),
p AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN size > 0 AND before + size / 2.0::DOUBLE <= target - epochs * source_size
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""

SQL = {"op2_mixing": _MIXING}
