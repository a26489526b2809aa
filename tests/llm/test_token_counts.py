"""Separator scan against the lengths of the token lists."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from clearwell.llm import token_counts as C
from tests.llm.cases import documents, texts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def check_starts(rows):
    files = defaultdict(list)
    for r in rows:
        files[r.file].append((r.doc_no, r.start, r.n_tokens))
    for found in files.values():
        at = 0
        for number, (doc_no, start, n_tokens) in enumerate(sorted(found)):
            assert (doc_no, start) == (number, at)
            at += n_tokens + 1


@pytest.mark.parametrize("block", [3, 1000, 1 << 18])
def test_edge_rows(spark, tmp_path, block):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    C.write_token_files(documents(spark), PATH, str(tmp_path / "files"))
    rows = C.count_tokens(spark, str(tmp_path / "files"), block).collect()
    assert Counter(r.n_tokens for r in rows) == Counter(len(model.encode(text or "")) for _, text in texts())
    assert all(r.closed for r in rows)
    check_starts(rows)


def test_files_without_an_end_and_without_anything(spark, tmp_path):
    end = C.END_ID
    for name, ids in {"a": [5, 6, end, end, 7], "b": [end], "c": [], "d": [9] * 10, "e": [4, end, 8, 8, end]}.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    for block in (1, 2, 3, 100):
        rows = C.count_tokens(spark, str(tmp_path), block).collect()
        found = sorted((r.file, r.doc_no, r.start, r.n_tokens, r.closed) for r in rows)
        assert found == [
            ("a", 0, 0, 2, True),
            ("a", 1, 3, 0, True),
            ("a", 2, 4, 1, False),
            ("b", 0, 0, 0, True),
            ("d", 0, 0, 10, False),
            ("e", 0, 0, 1, True),
            ("e", 1, 2, 2, True),
        ]


def test_empty_table(spark):
    assert C.corpus_counts(documents(spark, []), PATH).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=30))
def test_block_summary(ids):
    ends, head, tail, inner = C.block_summary(np.array(ids, "<u2"))
    runs = "".join("|" if i == C.END_ID else "x" for i in ids).split("|")
    assert ends == len(runs) - 1
    assert head == len(runs[0]) and tail == len(runs[-1])
    assert inner == [len(r) for r in runs[1:-1]]
