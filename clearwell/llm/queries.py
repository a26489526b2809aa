"""One query for each operator, with production parameters, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm import (
    bestfit_packing,
    decontamination,
    embedding_dedup,
    html_extraction,
    language_model,
    line_dedup,
    minhash_dedup,
    periodic_runs,
    quality_model,
    sql,
    substring_dedup,
    token_counts,
    token_output,
    whitening,
)
from clearwell.llm.common import ship_code, table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary file; the packing contract names this one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit_packing.packed(table(spark, sf_dir, "documents"), tokenizer_file())


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.corpus_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(table(spark, sf_dir, "pages"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of each sequence stands for its ids and positions, which ``write_matrices`` writes whole."""
    rows = token_output.packed_matrices(table(spark, sf_dir, "documents"), tokenizer_file())
    digests = [F.crc32(c).alias(f"{c}_crc32") for c in ("ids", "positions")]
    return rows.select("sequence_id", "n_tokens", "doc_ids", "pieces", "cumulative_lengths", *digests)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the lines that go, as text; ``without_repeated_lines`` gives the texts."""
    lines = line_dedup.repeated_lines(table(spark, sf_dir, "documents"))
    numbers = F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed")
    return lines.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), numbers)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.language_scores(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and digests of the runs of texts with planted periods; ``without_repetitions`` gives plain texts."""
    return periodic_runs.planted_runs(table(spark, sf_dir, "documents"))


def _on_executors(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return run(spark, sf_dir)

    return query


QUERIES = {
    run.__name__: _on_executors(run)
    for run in (
        op1_minhash_dedup,
        op2_quality_classifier,
        op3_bestfit_packing,
        op4_suffix_dedup,
        op5_token_counts,
        op6_decontamination,
        op7_html_extraction,
        op8_token_output,
        op9_embedding_dedup,
        op10_line_dedup,
        op11_embedding_whitening,
        op12_language_model,
        op13_periodic_runs,
    )
}
ORACLE_SQL = {
    "op1_minhash_dedup": sql.MINHASH,
    "op4_suffix_dedup": sql.SUBSTRINGS,
    "op9_embedding_dedup": sql.EMBEDDINGS,
    "op10_line_dedup": sql.LINES,
    "op13_periodic_runs": sql.RUNS,
}
