"""Registered queries of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import collocations, context_mixing, decontamination, jaccard_join, language_id, licenses, packing, quality_crf, quality_rules, secret_scan, substring_dedup, suffix_dedup, token_alignment
from tickloom.llm.frames import is_learned, read_table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "row.doc_id",
        "result.n_words",
        "result.n_hit",
        F.size("result.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("result.items", ","), 256).alias("items_sha256"),
        decontamination.is_contaminated().alias("contaminated"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = quality_rules.outliers(docs)
    stats = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("row.doc_id", *(f"result.{name}" for name in stats), "base_failed", "kept", "distance")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    learned = is_learned("doc_id", 5, 0)
    found = language_id.identify(docs.select("doc_id", "text"), docs.where(learned).select("text", "lang"))
    return found.select("row.doc_id", (~is_learned("row.doc_id", 5, 0)).alias("held_out"), "result.lang_pred", "result.score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs)
    return found.select("row.doc_id", "result.n_bytes", "result.n_removed", "result.n_spans", F.sha2("result.kept", 256).alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.remove_later(docs)
    return found.select("row.doc_id", "result.n_words", "result.n_removed", F.sha2(F.col("result.kept").cast("binary"), 256).alias("kept_sha256"))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = context_mixing.score(docs, docs.where(is_learned("doc_id", 10, 0)), keep_text=False)
    return found.select(
        "row.doc_id", (~is_learned("row.doc_id", 10, 0)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    learn = docs.where(is_learned("doc_id", 4, 2)).join(labels, "doc_id")
    model = quality_crf.train(learn, "doc_id", "text", "quality")
    found = quality_crf.score(docs, model)
    return found.select(
        "row.doc_id",
        (~is_learned("row.doc_id", 4, 2)).alias("held_out"),
        "result.score",
        (F.col("result.score") >= 0.7).cast("int").alias("predicted"),
    )


def tokenizer_json(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as held:
        return held.read()


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_json(), with_ids=False)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def model_bytes(name: str = "piece_bpe_32k.model") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as held:
        return held.read()


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align(docs, tokenizer_json("byte_bpe_50k.json"), model_bytes())


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES = {
    name: function
    for name, function in globals().items()
    if name.startswith("op") and callable(function)
}
