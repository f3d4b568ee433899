"""The named queries of this package, one for each operator.

Each takes (spark, folder), runs its operator over the whole table and derives the digest columns from its outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, digest, knn, lines, merkle, pieces, pii, quality, secrets, shards, simhash, sql, suffix, trie


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return digest.against_next(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.detect(table(spark, folder, "documents"))

    def number(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        F.col("id").alias("doc_id"),
        *[number(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.sha2(pii.listed("base"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.classes(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    digest = [F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")]
    cut = suffix.dedup(table(spark, folder, "documents"), digest=digest)
    return cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_lines(spark: SparkSession, folder: str) -> DataFrame:
    cut = lines.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("line_count").cast("bigint").alias("n_lines"),
        lines.removed_lines().cast("bigint").alias("n_removed"),
        F.size("removed_runs").cast("bigint").alias("n_runs"),
        F.array_join(
            F.transform("removed_runs", lambda r: F.concat_ws(":", r["start"], r["end"])), ","
        ).alias("runs"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op6_shards(spark: SparkSession, folder: str) -> DataFrame:
    body = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
    )
    return shards.assign(rows, ["doc_id"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_pieces(spark: SparkSession, folder: str, model_file: str = pieces.DEFAULT_MODEL) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = pieces.encode(docs, model_file, decoded="decoded")
    return both.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.col("text")).alias("restored"),
    )


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.scan(
        table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"),
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    rated = quality.classify(table(spark, folder, "documents").select("doc_id", "text"))
    return rated.select("doc_id", "votes", "posterior", "junk", (F.col("junk") <= quality.REJECT).alias("keep"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("start").cast("bigint").alias("start"),
        F.col("end").cast("bigint").alias("end"),
        F.sha2("value", 256).alias("value_sha256"),
        "chance",
        "secret",
    )


def op11_topk(spark: SparkSession, folder: str) -> DataFrame:
    return knn.search(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    own = trie.sequences(table(spark, folder, "conversations"))
    return trie.trie(*trie.rebuilt(*own)).drop("node", "parent")


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    found = merkle.prove(docs, altered={"text": F.when(hit, lowered).otherwise(F.col("text"))})
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", verified)


QUERIES = {
    "op1_fingerprint": op1_fingerprint,
    "op2_personal_data": op2_personal_data,
    "op3_simhash": op3_simhash,
    "op4_suffixes": op4_suffixes,
    "op5_lines": op5_lines,
    "op6_shards": op6_shards,
    "op7_pieces": op7_pieces,
    "op8_decontamination": op8_decontamination,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_topk": op11_topk,
    "op12_trie": op12_trie,
    "op13_merkle": op13_merkle,
}

SQL = {
    "op5_lines": sql.LINES,
    "op8_decontamination": sql.DECONTAMINATION,
    "op11_topk": sql.TOP_K,
    "op12_trie": sql.TRIE,
    "op13_merkle": sql.MERKLE,
}
