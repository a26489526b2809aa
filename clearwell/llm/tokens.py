"""Token ids of whole texts, word by word from a bounded cache.

The vocabulary of ``tokenizers`` used here cuts at white space before it merges, and none
of its normalisers acts across ASCII white space. So the ids of a text are those of its
words one after the other, and a word met before costs one look-up.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 1
# Words kept per Python worker, about 90 MB; beyond it the cache starts anew.
CACHE_WORDS = 400_000
# Punctuation that ends a plain word, and the bytes that stand for themselves in the vocabulary.
_ENDINGS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_OWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
_encoders: dict[str, WordEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    others = [b for b in range(256) if b not in set(_OWN_BYTES)]
    return {b: chr(b) for b in _OWN_BYTES} | {b: chr(256 + n) for n, b in enumerate(others)}


class WordEncoder:
    """Little-endian uint32 ids of texts by the tokenizer of a file, without special tokens."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known, self._parts = _Cache(self._ids), _Cache(self._merged)
        self._model = self._tokenizer.model
        self._letters = _byte_letters()

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def encode(self, text: str | None) -> bytes:
        """Ids as bytes; none for a null text."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        return b"".join(map(self._known.__getitem__, words))

    def _ids(self, word: bytes) -> bytes:
        """Ids of a word not met before.

        Latin letters and perhaps punctuation after them are two pieces for the merges, others are for the tokenizer.
        """
        letters = word.rstrip(_ENDINGS)
        # Of bytes, isalpha() means ASCII letters only.
        part = letters.lower() if letters.isalpha() else _lower_latin(letters)
        if part is None:
            found = self._tokenizer.encode_batch_fast([word.decode("utf-8", "replace")], add_special_tokens=False)
            return np.array(found[0].ids, "<u4").tobytes()
        if len(letters) == len(word):
            return self._parts[part]
        return self._parts[part] + self._parts[word[len(letters) :]]

    def _merged(self, part: bytes) -> bytes:
        spelled = part.decode() if part.isascii() else "".join(map(self._letters.__getitem__, part))
        found = [token.id for token in self._model.tokenize(spelled)]
        return struct.pack(f"<{len(found)}I", *found)


class _Cache(dict):
    """Ids by word; those of a new one are made when it is looked up, once the cache is full it starts anew."""

    def __init__(self, ids: Callable[[bytes], bytes]) -> None:
        self._make = ids

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = self[word] = self._make(word)
        return ids


def _lower_latin(letters: bytes) -> bytes | None:
    """Composed letters below U+0250 but U+0130 in lower case: one letter each, also in NFC. None if there are others."""
    text = letters.decode("utf-8", "replace")
    if not text.isalpha() or max(text) >= "\u0250" or "\u0130" in text:
        return None
    return text.lower().encode()


def _pieces(path: str, capacity: int, with_ids: bool):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(path)
        for batch in batches:
            rows: list[tuple] = []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = (id_, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").astype("<u2").tobytes()) if with_ids else row)
            columns = list(zip(*rows, strict=True)) or [()] * (6 if with_ids else 5)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(columns)]
            )

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each document's ids and ``END_ID`` after them.

    Only documents of more than ``capacity`` ids are cut, each cut but the last of full
    size. ``ids_crc32`` is over the ids as little-endian uint32. ``with_ids`` adds them as
    little-endian uint16 (the vocabulary has fewer than 65,536). Null texts are empty.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_pieces(tokenizer, capacity, with_ids), schema)
