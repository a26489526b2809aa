"""Documents and their token counts in flat, unindexed token files.

A token file is little-endian uint16 ids, one document after the other, each followed by
``END_ID``. Nothing says where documents begin. Each file is cut into blocks; a block
finds the end ids by one vectorised comparison and says how many tokens stand before
its first and after its last. A prefix scan over the blocks of a file (two window sums)
then gives what every block carries over from those before it, so a document may
span any number of blocks. A file stands for itself: a document does not go on in the next.

Files are written by Spark's text writer with the end id as the line separator, so any
store will do. Spark hands a file to one task: ``FILE_DOCUMENTS`` keeps those
written here small, and 2 GB is the limit for others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.session import shared_folder

# The id that ends a sentence in the vocabulary; ordinary text never gets it. As bytes it is valid UTF-8.
END_ID = 2
END_BYTES = "\x02\x00"
BLOCK_TOKENS = 1 << 18
FILE_DOCUMENTS = 50_000
# Characters of the texts encoded in one call.
_ENCODE_CHARACTERS = 2_000_000

_models: dict[str, object] = {}


def _model(path: str):
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            texts = [text or "" for text in batch.column(0).to_pylist()]
            ends = np.cumsum([len(text) for text in texts]) // _ENCODE_CHARACTERS
            for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends)) + 1):
                ids = model.encode([texts[k] for k in part], num_threads=1)
                flat = [np.array(one, "<u2").tobytes() for one in ids]
                yield pa.RecordBatch.from_arrays([pa.array(flat, pa.binary())], ["ids"])

    return run


def write_token_files(docs: DataFrame, model: str, path: str) -> None:
    """The ids of every whole text, null and empty ones as an end id alone, as flat files in a folder."""
    ids = docs.select(F.col("text").cast("string")).mapInArrow(_ids(model), "ids binary")
    ids = ids.select(F.col("ids").cast("string").alias("value"))
    ids.write.option("lineSep", END_BYTES).option("maxRecordsPerFile", FILE_DOCUMENTS).text(path)


def block_summary(ids: np.ndarray) -> tuple[int, int, int, list[int]]:
    """Ends in a block, tokens before the first and after the last (all of them, if none), lengths between."""
    at = np.flatnonzero(ids == END_ID)
    if not len(at):
        return 0, len(ids), len(ids), []
    return len(at), int(at[0]), len(ids) - int(at[-1]) - 1, (np.diff(at) - 1).tolist()


def _blocks(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(content.as_buffer(), "<u2", len(content.as_buffer()) // 2)
                rows = []
                for block, at in enumerate(range(0, len(ids), block_tokens)):
                    ends, head, tail, inner = block_summary(ids[at : at + block_tokens])
                    rows.append(
                        {"path": path, "block": block, "at": at, "ends": ends, "head": head, "tail": tail, "inner": inner}
                    )
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return run


_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("block", pa.int32()),
        ("at", pa.int64()),
        ("ends", pa.int64()),
        ("head", pa.int64()),
        ("tail", pa.int64()),
        ("inner", pa.list_(pa.int64())),
    ]
)


def count_tokens(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, doc_no, start, n_tokens, closed`` of every document in the token files of a folder.

    ``start`` counts tokens from the beginning of the file and ``n_tokens`` is without the end
    id. Tokens after the last end id are a document that is not ``closed``; a document
    without tokens counts 0; an empty file has no documents.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    schema = "path string, block int, at long, ends long, head long, tail long, inner array<long>"
    blocks = files.mapInArrow(_blocks(block_tokens), schema)
    # `run` numbers the stretches between blocks with an end; `carried` is a block's open end.
    scanned = blocks.selectExpr(
        "*",
        "sum(ends) OVER (PARTITION BY path ORDER BY block) - ends AS before",
        "sum(int(ends > 0)) OVER (PARTITION BY path ORDER BY block) AS run",
        "lead(block) OVER (PARTITION BY path ORDER BY block) IS NULL AS last",
    )
    scanned = scanned.selectExpr("*", "sum(tail) OVER (PARTITION BY path, run ORDER BY block) AS carried")
    scanned = scanned.selectExpr(
        "*", "coalesce(lag(carried) OVER (PARTITION BY path ORDER BY block), 0) AS brought"
    )
    # The documents that end in a block, and the open one at the end of a file.
    closed = "CASE WHEN ends > 0 THEN concat(array(head + brought), inner) ELSE array() END"
    documents = scanned.selectExpr(
        "path", "before", "at - brought AS first", f"{closed} AS lengths", "last", "ends", "carried"
    )
    documents = documents.selectExpr(
        "path",
        "before",
        "first",
        "CASE WHEN last AND carried > 0 THEN concat(lengths, array(carried)) ELSE lengths END AS lengths",
        "size(lengths) AS ended",
    )
    # Running sums within a block, without a Python loop over documents.
    spread = documents.selectExpr("path", "before", "first", "ended", "posexplode(lengths) AS (nth, n_tokens)")
    return spread.selectExpr(
        "element_at(split(path, '/'), -1) AS file",
        "before + nth AS doc_no",
        "first + sum(n_tokens + 1) OVER (PARTITION BY path, before, first ORDER BY nth) - n_tokens - 1 AS start",
        "n_tokens",
        "nth < ended AS closed",
    )


def corpus_counts(docs: DataFrame, model: str) -> DataFrame:
    """``count_tokens`` of token files made from ``docs(text, ...)`` in the shared folder."""
    path = shared_folder(docs.sparkSession, "token-files")
    write_token_files(docs, model, path)
    return count_tokens(docs.sparkSession, path)
