"""Training-text pipeline over ``documents``: STAGES in order, each written as Parquet before the next reads it.

Low-quality documents go, then repeated lines, then all but the first document of each group of near copies, then
documents that hold benchmark text; the rest is packed into batches of like length. All but the last stage return the
columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm.common import not_remainder, numbered, settle, unused
from finlake.llm.decontaminate import contamination
from finlake.llm.jaccard import similarity_classes
from finlake.llm.line_dedup import drop_repeated_lines
from finlake.llm.packing import pack
from finlake.llm.quality import fit, with_scores
from finlake.session import configure

#: The classifier, the order of documents in slots and the batches have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MIN_QUALITY = 0.7


def without_rows(docs: DataFrame, row: str, rows: DataFrame) -> DataFrame:
    """The table less the rows whose stored number (column ``row``) is in ``rows``, without the number."""
    return docs.join(rows.select(F.col("row").alias(row)), row, "left_anti").drop(row)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below MIN_QUALITY go; labels that are held out in the classifier's query are held out here.

    Null and empty texts are scored like any other; repeated rows stay or go together. Without any usable label nothing is
    known of quality, and all documents stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels, not_remainder(F.col("doc_id"), 4, 2))
    if not model.rows:
        return docs
    score = unused("__score", docs.columns)
    return with_scores(docs, model, "text", score).where(F.col(score) >= MIN_QUALITY).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated long lines go; n_chars, if there is such a column, follows the text.

    Null texts stay null, and no row goes; see ``drop_repeated_lines`` for ids that repeat or are missing.
    """
    kept = drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        length = F.when(F.col("__dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", length)
    return kept.select(docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles the one with the smallest id stays.

    Null and empty texts link with nothing and stay; of rows that repeat id and text one stays.
    """
    row = unused("__row", docs.columns)
    docs = numbered(docs, row)
    return without_rows(docs, row, similarity_classes(docs, row_col=row).where("row <> first_row"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any word inside a benchmark window go; null and empty texts stay."""
    row = unused("__row", docs.columns)
    docs = numbered(docs, row)
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), row_col=row)
    return without_rows(docs, row, found.where("n_hit > 0"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's segments lie in batches of like length; a null or empty text is one empty segment."""
    return pack(docs, TOKENIZER).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
