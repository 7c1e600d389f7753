"""Queries over the corpus tables, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import fingerprints, line_dedup, mixing, negatives, packing, periods, pii, quality, secrets, sharding, simhash, suffixes, topk
from tallyspark.llm.common import read_table


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_removed")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file())


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows as they come back from the compacted shards; no tier may be left with shards enough to merge."""
    store, rows = sharding.shard_documents(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.octet_length("text").cast("long").alias("text_bytes"), F.sha2("text", 256).alias("text_sha256"), F.lit(store.full_tiers()).cast("long").alias("full_tiers"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(read_table(spark, sf_dir, "documents")).drop("found")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents")).drop("found")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(read_table(spark, sf_dir, "documents"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """The texts of a tenth of the ids, by a hash, end in a stretch of their own words that repeats."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    d = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    d = d.withColumn("n", F.when(F.col("w").isNotNull(), F.size("w")).otherwise(0))
    d = d.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    d = d.withColumn("p", (F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1).cast("int"))
    unit, rest = F.slice("w", F.col("a") + 1, F.col("p")), F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    edited = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return d.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(planted_repeats(read_table(spark, sf_dir, "documents")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    longest = periods.longest_run(F.col("runs"))
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("(-1000 * longest.less) div longest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare_with_edited(read_table(spark, sf_dir, "documents"))
    edited = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    return found.select("doc_id", "n_chars", edited, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0, label)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_quality_rules": op3_quality_rules,
    "op4_sharding": op4_sharding,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_pii": op7_pii,
    "op8_mixing": op8_mixing,
    "op9_secret_scan": op9_secret_scan,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_hard_negatives": op13_hard_negatives,
}
