"""Documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read
again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm import bestfit_packing, decontamination, line_dedup, minhash_dedup, quality_model
from clearwell.llm.common import ship_code, stored, table
from clearwell.llm.queries import tokenizer_file

# The classifier, the bandings and the packing have no SQL form.
ORACLE_SQL: str | None = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by a model of the labels that are not held out."""
    ship_code(spark)
    return quality_model.accepted(docs, quality_model.fit(docs, table(spark, sf_dir, "labels")))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that occur in an earlier one; ``n_chars`` counts what is left."""
    kept = line_dedup.without_repeated_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of similar ones (five words, 80 per cent)."""
    ship_code(spark)
    return minhash_dedup.deduplicated(docs, minhash_dedup.FIVE_WORDS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_code(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece: its document, its tokens and its place in a training sequence."""
    ship_code(spark)
    return bestfit_packing.packed(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("minhash near-dedup", near_deduplication),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
