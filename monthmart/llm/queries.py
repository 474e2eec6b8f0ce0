"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import materialize
from . import (
    bpe, chat, codes, decontamination, extraction, licenses, nearest, neardup, packing, quality, sharding, spelling, toxicity,
)
from .oracle import ORACLE


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("findings")


def op2_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "class_texts")


def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    keys = {
        "doc_id": F.col("doc_id"),
        "size": F.octet_length(text).cast("bigint") + 1,
        "text_crc32": F.crc32(text.cast("binary")),
    }
    return sharding.shard(read(spark, sf_dir, "documents"), keys).select(
        *keys, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )


def tool_log(conversations: DataFrame) -> DataFrame:
    """The conversations as a log with tool calls: every reply becomes the result of a call made for it.

    The assistant's message at turn t turns into a call "c<t>" of tool reply, its text into the result. The result of every third
    call stands before it, as in logs written out of order. Of four replies the first refers to the second, the second to the
    fourth, the third back to the second, and in every fifth conversation the fourth to the first, which closes a cycle.
    Arguments hold numbers as strings, quoted text and nested values; some calls have a length of the wrong type or none, some have no result.
    """
    replies = conversations.filter("role = 'assistant'")
    turn, place, conv = F.col("turn").cast("string"), F.floor(F.col("turn") / 2) % 4, F.col("conv_id")
    other = F.when(place == 0, 2).when(place == 1, 4).when(place == 2, -2).when((place == 3) & (conv % 5 == 0), -6)
    after = F.when(other.isNotNull(), F.concat(F.lit('"after":"$c'), (F.col("turn") + other).cast("string"), F.lit('",')))
    size = F.length("text").cast("string")
    length = F.when((conv % 4 == 1) & (place == 2), F.concat(F.lit('"length":"'), size, F.lit('",'))).when(
        ~((conv % 4 == 2) & (place == 3)), F.concat(F.lit('"length":'), size, F.lit(",")))
    call = F.concat(
        F.lit('{"tool_calls":[{"id":"c'), turn, F.lit('","name":"reply","arguments":{"turn":'), turn, F.lit(","),
        F.coalesce(length, F.lit("")), F.coalesce(after, F.lit("")), F.lit('"quote": '), chat.quoted(F.substring("text", 1, 16)),
        F.lit(',"code":"'), turn, F.lit('","meta":{"z":['), turn, F.lit(',{"y":true,"x":null}],"a":"[draft] a]"}}}]}'),
    )
    result = F.concat(F.lit('{"tool_call_id":"c'), turn, F.lit('","content":'), chat.quoted(F.col("text")), F.lit("}"))
    early = (F.col("turn") % 3 == 0).cast("int")
    at = F.col("turn") * 4
    return (
        conversations.filter("role IS NULL OR role != 'assistant'").select("conv_id", at.alias("turn"), "role", "text")
        .unionByName(replies.select("conv_id", (at + early * 2).alias("turn"), "role", F.coalesce(call, F.lit("")).alias("text")))
        .unionByName(replies.filter(~((conv % 3 == 0) & (place == 1))).select(
            "conv_id", (at + 1).alias("turn"), F.lit("tool").alias("role"), result.alias("text")))
    )


TOOLS = [("reply", ["turn", "length"], {
    "turn": "integer", "length": "integer", "after": "string", "code": "string", "quote": "string", "meta": "object"})]


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = spark.createDataFrame(TOOLS, chat.SCHEMAS_SCHEMA)
    formatted = chat.format_chats(tool_log(read(spark, sf_dir, "conversations")), schemas)
    return formatted.withColumn("call_ids", F.array_join("call_ids", ","))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("text_hash")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(read(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("text_hash")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_windows", "found_windows", "share", "slots", "consistent")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(read(spark, sf_dir, "embeddings"))


def vector_codes(vectors: DataFrame) -> DataFrame:
    found = codes.compress(vectors)
    if found is None:
        schema = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    coded = materialize(found.codes, "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    entries = hashlib.sha256(",".join(map(str, found.codebooks.ravel().tolist())).encode()).hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(entries).alias("codebooks_sha256")
    )


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(read(spark, sf_dir, "documents"))


def byte_bpe(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    decoded = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def one_deleted(doc_id: Column, run: Column) -> Column:
    """The run without one character if 97 divides the checksum of the document's id and the run, which also says which one."""
    checksum = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = F.pmod(checksum, F.char_length(run)).cast("int")
    rest = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(checksum % 97 == 0, rest).otherwise(run)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(read(spark, sf_dir, "documents"), one_deleted))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_probminhash": op2_probminhash,
    "op3_extraction": op3_extraction,
    "op4_packing": op4_packing,
    "op5_sharding": op5_sharding,
    "op6_chat": op6_chat,
    "op7_quality": op7_quality,
    "op8_nearest": op8_nearest,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_vector_codes": op11_vector_codes,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_spelling": op13_spelling,
}

