"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laurel.llm import decontaminate, language_id, line_dedup, order_minhash, sentencepiece_codec
from laurel.llm.common import small_batches, table
from laurel.llm.queries import tokenizer_file
from laurel.session import staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter) go; nothing to learn from leaves those with letters in place."""
    small_batches(spark)
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = docs.withColumn("_found", language_id.predict(F.col("text"), model, spark))
    return found.where(F.col("_found.lang") != language_id.UNKNOWN).drop("_found")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose lines that other documents keep; documents that had text and are left without any go."""
    small_batches(spark)
    found = line_dedup.line_dedup(docs, out="_lines")
    text = F.col("_lines.text")
    found = found.where(~((F.col("_lines.n_dropped") > 0) & (F.trim(text) == "")))
    return found.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).drop("_lines")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    small_batches(spark)
    return order_minhash.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    small_batches(spark)
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"), out="_hits")
    return found.where(~decontaminate.contaminated(F.col("_hits"))).drop("_hits")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether they decode to it."""
    small_batches(spark)
    coded = docs.withColumn("_coded", sentencepiece_codec.coded(F.col("text"), tokenizer_file("piece_bpe_32k.model")))
    text = F.coalesce(F.translate("text", sentencepiece_codec.BLANK, " "), F.lit(""))
    return coded.select("doc_id", "lang", "source", F.size("_coded.ids").cast("long").alias("n_tokens"), "_coded.ids", (F.col("_coded.text") == text).alias("round_trip"))


STAGES = [("language_id", identify_language), ("line_dedup", dedup_lines), ("near_dedup", near_dedup),
          ("decontamination", remove_benchmark), ("sentencepiece", encode)]

#: Language ID, Order MinHash and Viterbi have no SQL form; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
