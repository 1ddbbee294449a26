"""A corpus pipeline over the documents table: language, near duplicates, repeated text, benchmark, packing.

All stages but the last return the columns they get, whatever they are called, and work on whole texts. An empty
table gives an empty table. Columns other than id and text may be null or missing and decide nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontamination, jaccard_join, language_id, packing, suffix_dedup
from tickloom.llm.frames import is_learned, read_table, write_table
from tickloom.llm.queries import tokenizer_json
from tickloom.session import shared_folder

# A document goes when it has no letter, or when it is long enough to tell and unlike every language.
TELLING_LETTERS = 200
MIN_LANGUAGE_SCORE = 0.15
# Near duplicates: 80 percent of the shingles of five words are the same.
NEAR_WORDS = 5
NEAR_PERCENT = 80
# Passages of more than 50 words: with their spaces, words of three letters already take 200 bytes.
REPEATED_BYTES = 200


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language.

    Null texts and texts without a letter go, short ones stay. Repeated rows share one decision.
    """
    found = language_id.identify(docs, docs.where(is_learned("doc_id", 5, 0)))
    unlike = (F.col("result.score") < MIN_LANGUAGE_SCORE) & (F.col("result.n_letters") >= TELLING_LETTERS)
    return found.where((F.col("result.lang_pred") != language_id.UNDEFINED) & ~unlike).select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates; one row if that id is repeated.

    A null id is the smallest. Documents without a word are in no group and all stay, nulls included.
    """
    found = jaccard_join.join_components(docs, percent=NEAR_PERCENT, words=NEAR_WORDS)
    # Rows without shingles are in no group. A null id is the smallest of all.
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    leads = found.where((F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        key.alias("kept_id"), (F.col("n_shingles") == 0).alias("alone")
    ).distinct()
    word = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    numbered = docs.select(F.struct("*").alias("row"), key.alias("kept_id"), word.alias("word"))
    kept = numbered.join(leads, "kept_id").where(F.col("alone") != F.col("word"))
    # The rows lie by id after the join, so texts are not shuffled once more. Rows without a word all stay.
    own = F.when(F.col("word"), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    return kept.withColumn("own", own).dropDuplicates(["kept_id", "own"]).select("row.*")


def cut_repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of ``REPEATED_BYTES`` or more that also stand elsewhere, in the same text or another.

    All occurrences go, also between rows of one id. A null text becomes an empty one, a text of nothing
    but repeats stays as an empty one. ``n_chars`` follows the text where the table has it.
    """
    found = suffix_dedup.remove_repeats(docs, window=REPEATED_BYTES, as_text=True)
    names = [F.col("result.kept").alias("text") if name == "text" else F.col(f"row.`{name}`") for name in docs.columns]
    cut = found.select(*names)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark; null and empty texts stay."""
    found = decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(~decontamination.is_contaminated()).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; see ``packing.pack``. Every row is packed; a null or empty text is its end token alone."""
    return packing.pack(docs, tokenizer_json())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("jaccard_join", keep_one_of_each_group),
    ("suffix_dedup", cut_repeated_text),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Language profiles and packing cannot be expressed in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        write_table(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
    return docs
