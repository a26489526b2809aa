"""Both packings: nothing lost, nothing over capacity, few sequences, exact ids."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clearwell.llm import bestfit_packing as B
from clearwell.llm import token_output as T
from clearwell.llm import tokens
from clearwell.llm.tokens import WordEncoder
from tests.llm.cases import documents, texts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "á ́b ΣΑΣ ΣΑΣ. x\x1cy <|endoftext|> <|startoftext|>a İstanbul don't I'll 's",
    "Straße!!! ŉx ŀ ªº ǅ ſ ÀÉ. aʼn a_b __ a-b. -a x<|endoftext|>",
    "\x85 \x0b\x0c 한국어 日本 😀😀 a​b \xa0 ȩ́",
    '"quoted" #tag @me 1,234.5% ** ???!',
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def expected(plain, rows):
    return [[*plain.encode(text or "", add_special_tokens=False).ids, 1] for _, text in rows]


def test_word_by_word_ids_are_the_tokenizers(plain):
    encoder = WordEncoder(PATH)
    for text in [*ODD, *(t for _, t in texts() if t)]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert encoder.encode(None) == b""


def test_a_text_of_more_words_than_the_cache_keeps_its_bound(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 5)
    encoder, tokenizer = WordEncoder(PATH), Tokenizer.from_file(PATH)
    text = " ".join(f"Word{'abcdefghij'[k % 10] * (k // 10 + 1)}, {k} été{k} 漢{k}" for k in range(40)) + " worda, Worda"
    for _ in range(2):
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder._known) <= 5 and len(encoder._parts) <= 5



def check_plan(counts, capacity):
    plan, fill, ranks = B.make_plan(counts, capacity), defaultdict(list), defaultdict(list)
    for row in zip(plan.length, plan.rank, plan.count, plan.sequence, plan.offset, plan.each, strict=True):
        length, rank, count, sequence, offset, each = map(int, row)
        for k in range(count):
            fill[sequence + k // each].append((offset + k % each * length, length))
            ranks[length].append(rank + k)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items() if c}
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(fill) == plan.sequences
    return plan.sequences


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 60), max_size=40))
def test_plan_places_every_piece_once(counts):
    sequences = check_plan(counts, 64)
    total = sum(n * c for n, c in counts.items())
    # No packing by best fit leaves two sequences half empty.
    assert total / 64 <= sequences <= max(1, 2 * total / 64 + 1) if total else sequences == 0


def test_plan_is_near_the_least_number():
    rng = np.random.default_rng(1)
    lengths = np.clip(np.exp(rng.normal(6.3, 1.1, 20_000)), 2, 4096).astype(int)
    assert check_plan(dict(Counter(lengths.tolist())), 4096) <= -(-lengths.sum() // 4096) + 2
    assert check_plan({2049: 7}, 4096) == 7
    assert check_plan({4096: 4, 1: 3}, 4096) == 5
    # Pairs and triples that only fit each other.
    assert check_plan({3000: 50, 1096: 50, 1365: 300}, 4096) == 150


def test_configurations_beat_first_fit():
    # 6 + 3 + 3 and 4 + 4 + 4 fill 12; first fit would pair 6 with 4.
    used = B.configurations([6, 4, 3], [20, 30, 40], 12)
    assert sum(uses for _, uses in used) == 30
    with pytest.raises(ValueError):
        B.make_plan({13: 1}, 12)


def test_packed_edge_rows(spark, plain):
    rows = [*texts(), *((500 + k, text) for k, text in enumerate(ODD))]
    found = B.packed(documents(spark, rows), PATH).collect()
    want = Counter()
    for (id_, _), ids in zip(rows, expected(plain, rows), strict=True):
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want[id_, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    fill = defaultdict(list)
    for r in found:
        fill[r.sequence_id].append((r.offset, r.length))
    for places in fill.values():
        assert [o for o, _ in sorted(places)] == np.cumsum([0, *(n for _, n in sorted(places))])[:-1].tolist()
        assert sum(n for _, n in places) <= 4096
    assert len(fill) <= -(-sum(r.length for r in found) // 4096) + 1
    assert B.packed(documents(spark, []), PATH).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_segment_tree_is_best_fit(lengths):
    free, bins = [], []
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = [f for f in free if f >= lengths[k]]
        if room:
            b = max(i for i, f in enumerate(free) if f == min(room))
        else:
            free.append(32)
            bins.append([])
            b = len(bins) - 1
        free[b] -= lengths[k]
        bins[b].append(k)
    got = T.best_fit_decreasing(lengths, 32)
    assert sorted(k for b in got for k in b) == list(range(len(lengths)))
    assert sorted(sum(lengths[k] for k in b) for b in got) == sorted(sum(lengths[k] for k in b) for b in bins)


def test_matrices_are_a_lossless_round_trip(spark, plain, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "GROUP_TOKENS", 4000)
    rows = [*texts(), *((500 + k, text) for k, text in enumerate(ODD))]
    path = str(tmp_path / "matrices")
    T.write_matrices(documents(spark, rows), PATH, path, capacity=512)
    T.write_matrices(documents(spark, rows), PATH, path, capacity=512)
    got = Counter()
    parts = defaultdict(list)
    found = spark.read.parquet(path).collect()
    for r in found:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(positions) == 512
        assert r.cumulative_lengths[-1] == r.n_tokens <= 512
        assert not ids[r.n_tokens :].any() and not positions[r.n_tokens :].any()
        for doc, piece, low, high in zip(r.doc_ids, r.pieces, r.cumulative_lengths, r.cumulative_lengths[1:], strict=False):
            assert positions[low:high].tolist() == list(range(high - low))
            got[doc, piece, ids[low:high].tobytes()] += 1
            parts[doc].append(piece)
    want = Counter()
    for (id_, _), ids in zip(rows, expected(plain, rows), strict=True):
        for piece, at in enumerate(range(0, len(ids), 512)):
            want[id_, piece, np.array(ids[at : at + 512], "<u2").tobytes()] += 1
    assert got == want
    assert len({r.sequence_id for r in found}) == len(found)
    assert T.packed_matrices(documents(spark, []), PATH).collect() == []
