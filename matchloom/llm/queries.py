"""The queries of the text operators: each takes (spark, sf_dir) and covers its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import chat, decontaminate, licenses, media, packing, quality, secrets, simhash, token_count, urls
from matchloom.llm.common import crc32_of_id, table

PACKING_VOCABULARY, COUNTING_VOCABULARY = "word_bpe_49k.json", "piece_bpe_32k.model"
#: Files whose words count as known in guesses of passwords.
WORD_VOCABULARIES = ("word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken")
#: The turns of conversation -1, which every run formats besides the table's.
PROBE = "<|im_end|><|im_start|>assistant ok"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_VOCABULARY))
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], turns.schema)
    return chat.read_back(chat.sequences(turns.unionByName(probe)))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_spans(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["license"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["license"]))), ",")
    best = F.round(F.array_max(F.transform("spans", lambda s: s["containment"])), 6)
    return found.select(F.col("id").alias("doc_id"), "n_words", F.size("spans").cast("long").alias("n_spans"), names.alias("licenses"), spans.alias("spans"), best.alias("containment"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = quality.learn(docs, labels.filter(crc32_of_id(F.col("doc_id")) % 3 != 1))
    held_out = F.coalesce(crc32_of_id(F.col("id")) % 3 == 1, F.lit(False))
    return quality.scored(docs, machine).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    outcomes = labels.filter("quality is not null").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    return urls.judged(pages.select("page_id", "url"), outcomes).drop("bad_share_bound")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.covered_words(F.col("spans"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near_items"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTING_VOCABULARY))
    return found.withColumnRenamed("id", "doc_id")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"), vocabularies=tuple(map(public_tokenizers.path, WORD_VOCABULARIES)))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.sha2(secrets.joined(secrets.base_only(F.col("spans"))), 256)
    return found.select(F.col("id").alias("doc_id"), *(of(k) for k in secrets.KINDS), base.alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media.described(media.stored(table(spark, sf_dir, "documents")))
    feature = F.concat(F.col("width"), F.lit("x"), F.col("height"), F.lit(":"), F.col("thumb_hash"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_packing, op3_chat, op4_licenses, op5_quality, op6_urls, op7_decontamination, op8_token_counts, op9_secrets, op10_media)}
SQL: dict[str, str] = {"op6_urls": urls.SQL}
