"""Language-model scores of documents by a hidden Markov model.

A text is its words between ASCII white space, A-Z in lower case, and one end. Latent
states follow each other by a transition matrix and give out words. Baum-Welch trains
them on the documents that are not held out; the scaled forward recursion gives the exact
probability of a whole text.

* Documents become *blocks* of about ``BLOCK_TOKENS`` tokens with a dictionary of their own,
  so a word is sent once a block however often it occurs. Words are known by a 64-bit
  hash; its upper end names the *shard* of the vocabulary that counts the word.
* A block sends each shard the hashes of its words as one row, and gets their counts, or
  what the model says of them, as one row. A shard is streamed: it holds its own words and one
  message. Shards and blocks both grow in number with the corpus, not in size.
* A word seen ``LEAST_COUNT`` times or more is shared out among the states: its expected counts
  and half a count, shared out like all tokens, make its probability in each state. The shares
  are kept, and travel, as 16-bit fractions. Rarer words, and one that stands for all unknown
  ones, have their counts and half a count times a factor of the state, learnt for all of them
  together. The probabilities of a state add up to one.
* Long texts are cut into pieces only to be worked on at once: the matrix that carries the
  states over each piece joins them again, exactly.

The first state of a word follows from its hash and the states persist at first, so
training starts alike at every size. Every round covers every training document.

Null and empty texts are one end. A null id is never held out; repeated rows and ids are
rows of their own and count as often as they come. A text of any length is scored whole,
in memory of a few times its size. Without training documents every token is unknown, with
probability 1. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import ship_code, stored

STATES, ROUNDS = 8, 3
BLOCK_TOKENS, AT_ONCE = 4_000_000, 1_000_000
# Texts of more tokens than the first are cut into pieces of the second.
LONG, PIECE = 4096, 1024
_PIECES_AT_ONCE = 2048
# Probabilities are scaled after so many tokens, in double precision.
_SCALED_EVERY = 8
SHARD_WORDS = 1_000_000
LEAST_COUNT = 5
# The first model: how much of a word is in the state of its hash, how often a state stays.
OWN_SHARE, PERSISTENCE = 0.7, 0.98
HELD_OUT_OF, HELD_OUT = 5, 1

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SLICE = 1 << 20
# No word holds white space.
END = b"\n"
# Sums that belong to no shard of words are spread over rows of their own.
_SPREAD = 64
_PARTS = 65535


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


# Blocks.


class _Numbers(dict):
    """Numbers things in the order in which they are asked for."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def _word_lists(text: str | None) -> Iterator[list[bytes]]:
    data = (text or "").encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        gap = _SPACE.search(data, at + _SLICE)
        end = gap.start() if gap else len(data)
        yield data[at:end].translate(_LOWER).split()
        at = end
    yield [END]


def _squeezed(values: np.ndarray, kind: str = "<i4") -> bytes:
    """Small integers, the bytes of like weight together, compressed."""
    planes = np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, int(kind[-1])).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unsqueezed(data: bytes, kind: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(int(kind[-1]), -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# ``hashes`` and ``n``, the number of occurrences, are in the order of the hashes, where word k is number ``order[k]``.
_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("held_out", pa.bool_()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.binary()),
        ("tokens", pa.binary()),
        ("words", pa.int64()),
        ("order", pa.binary()),
        ("hashes", pa.binary()),
        ("n", pa.binary()),
    ]
)
_BLOCK_DDL = (
    "block long, held_out boolean, doc_ids array<long>, lengths binary, tokens binary, words long, "
    "order binary, hashes binary, n binary"
)


class _Block:
    def __init__(self, held: bool) -> None:
        self.held = held
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        length = 0
        for words in _word_lists(text):
            self.tokens.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
            length += len(words)
        self.ids.append(doc_id)
        self.lengths.append(length)
        self.size += length

    def row(self, block: int) -> pa.RecordBatch:
        tokens = np.concatenate(self.tokens)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.numbers), np.uint64, len(self.numbers))
        order = np.argsort(hashes)
        row = {
            "block": block,
            "held_out": self.held,
            "doc_ids": self.ids,
            "lengths": _squeezed(np.array(self.lengths)),
            "tokens": _squeezed(tokens),
            "words": len(hashes),
            "order": _squeezed(order),
            "hashes": hashes[order].tobytes(),
            "n": _squeezed(np.bincount(tokens, minlength=len(hashes))[order]),
        }
        self.clear()
        return pa.RecordBatch.from_pylist([row], _BLOCK)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    open_blocks = [_Block(False), _Block(True)]
    for batch in batches:
        for doc_id, held, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            block = open_blocks[held]
            block.add(doc_id, text)
            if block.size >= BLOCK_TOKENS:
                yield block.row(number)
                number += 1
    for block in open_blocks:
        if block.ids:
            yield block.row(number)
            number += 1


def blocks_of(documents: DataFrame) -> DataFrame:
    """The documents as blocks of numbered tokens, those held out apart."""
    rows = documents.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held"), "text")
    return rows.mapInArrow(_to_blocks, _BLOCK_DDL)


# Messages between blocks and shards.


def _shards_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each hash; shards follow the order of the hashes."""
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)


def _slices(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    owner = _shards_of(hashes, shards)
    edges = np.flatnonzero(np.diff(owner)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(owner)], strict=True):
        if high > low:
            yield int(owner[low]), low, high


def _asked(shards: int):
    """A row for each block and shard: the hashes of its words there, and how often the block has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes, n = np.frombuffer(packed, "<u8"), _unsqueezed(numbers)
                rows = [(s, block, hashes[a:b].tobytes(), _squeezed(n[a:b])) for s, a, b in _slices(hashes, shards)]
                if rows:
                    yield _batch(rows, _ASKED)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)], schema=schema
    )


_ASKED = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])
_VOCABULARY = pa.schema(
    [
        ("shard", pa.int32()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
        ("tokens", pa.int64()),
        ("distinct", pa.int64()),
        ("rare", pa.int64()),
        ("frequent", pa.int64()),
    ]
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _summed(keys: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, inverse, np.concatenate(numbers))
    return distinct, total


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each shard, from messages sorted by shard."""
    for shard, messages in groupby(_rows(batches), key=lambda row: row[0]):
        keys, numbers, waiting = [], [], 0
        for _, _, packed, n in messages:
            keys.append(np.frombuffer(packed, "<u8"))
            numbers.append(_unsqueezed(n).astype(np.int64))
            waiting += len(keys[-1])
            if waiting > max(SHARD_WORDS, len(keys[0])):
                merged = _summed(keys, numbers)
                keys, numbers, waiting = [merged[0]], [merged[1]], 0
        distinct, total = _summed(keys, numbers)
        rare, frequent = int(total[total < LEAST_COUNT].sum()), int((total >= LEAST_COUNT).sum())
        row = (shard, distinct.tobytes(), _squeezed(total, "<i8"), int(total.sum()), len(distinct), rare, frequent)
        yield _batch([row], _VOCABULARY)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each message the counts of its words, and which of the frequent words of the shard they are."""
    own, known, counts, rank = None, np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    for shard, block, packed, numbers in _rows(batches):
        keys = np.frombuffer(packed, "<u8")
        if block is None:
            own, known, counts = shard, keys, _unsqueezed(numbers, "<i8")
            rank = np.cumsum(counts >= LEAST_COUNT) - 1
            continue
        found = np.zeros(len(keys), np.int64)
        frequent = np.empty(0, np.int64)
        if own == shard:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            found = np.where(known[at] == keys, counts[at], 0)
            frequent = rank[at[found >= LEAST_COUNT]]
        yield _batch([(shard, block, _squeezed(found, "<i8"), _squeezed(frequent))], _ANSWER)


_ANSWER = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("counts", pa.binary()), ("frequent", pa.binary())])


def _by_shard(own: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages of a shard behind the row of the shard, which has no block."""
    both = own.unionByName(messages, allowMissingColumns=True).select(messages.columns)
    return both.repartition("shard").sortWithinPartitions("shard", F.asc_nulls_first("block"))


# The model.


@dataclass(frozen=True)
class Parameters:
    """What is small: bounded by the number of states."""

    tokens: int
    distinct: int
    rare_tokens: int
    frequent: int
    totals: np.ndarray  # expected tokens of a state
    rare: np.ndarray  # of them, rare words
    first: np.ndarray
    following: np.ndarray

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))

    def emissions(self, counts: np.ndarray, local: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """Probability of each word in each state; ``shares`` are those of the frequent ones, at ``local``."""
        if not self.tokens:
            return np.ones((len(counts), STATES))
        size = self.totals / self.tokens
        factor = self.rare / self.rare_tokens if self.rare_tokens else size
        whole = self.totals + 0.5 * size * self.frequent + 0.5 * factor * (self.distinct - self.frequent + 1)
        result = (counts[:, None] + 0.5) * factor / whole
        result[local] = (counts[local, None] * shares + 0.5 * size) / whole
        return result


@dataclass(frozen=True)
class Model:
    """``vocabulary`` and ``words`` have a row for each shard: hashes and counts, shares of the frequent words."""

    shards: int
    vocabulary: DataFrame
    words: DataFrame
    parameters: Parameters


def _packed_shares(expected: np.ndarray) -> bytes:
    """Rows of expected counts as fractions of their sums."""
    return _squeezed(np.rint(expected / expected.sum(axis=1, keepdims=True) * _PARTS).ravel(), "<u2")


def _shares(data: bytes) -> np.ndarray:
    parts = _unsqueezed(data, "<u2").reshape(-1, STATES).astype(float)
    return parts / parts.sum(axis=1, keepdims=True)


def vocabulary_of(blocks: DataFrame, shards: int) -> DataFrame:
    """Every word of the training documents, by hash, and how often it occurs."""
    asked = blocks.where("NOT held_out").select("block", "hashes", "n").mapInArrow(_asked(shards), _ddl(_ASKED))
    sorted_ = asked.repartition("shard").sortWithinPartitions("shard")
    return sorted_.mapInArrow(_counted_words, _ddl(_VOCABULARY))


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.float64(): "double", pa.bool_(): "boolean"}
    return ", ".join(f"{field.name} {kinds[field.type]}" for field in schema)


def counts_of(blocks: DataFrame, vocabulary: DataFrame, shards: int) -> DataFrame:
    """A row for each block and shard: training counts of the block's words there, and which are frequent."""
    asked = blocks.select("block", "hashes", "n").mapInArrow(_asked(shards), _ddl(_ASKED))
    own = vocabulary.select("shard", "keys", F.col("counts").alias("n"))
    return _by_shard(own, asked).mapInArrow(_answers, _ddl(_ANSWER))


_WORDS = pa.schema([("shard", pa.int32()), ("shares", pa.binary()), *[(f"e{k}", pa.float64()) for k in range(STATES)]])


def _first_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Persistent states, each with the words whose hashes name it."""
    for shard, packed, numbers in _rows(batches):
        counts = _unsqueezed(numbers, "<i8")
        frequent = counts >= LEAST_COUNT
        keys = np.frombuffer(packed, "<u8")[frequent]
        expected = np.full((len(keys), STATES), (1 - OWN_SHARE) / STATES)
        expected[np.arange(len(keys)), (keys % np.uint64(STATES)).astype(int)] += OWN_SHARE
        yield _words_row(shard, expected, counts[frequent])


def _words_row(shard: int, expected: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    packed = _packed_shares(expected)
    return _batch([(shard, packed, *(counts @ _shares(packed)).tolist())], _WORDS)


def _total(words: DataFrame) -> np.ndarray:
    return np.array(words.agg(*[F.coalesce(F.sum(f"e{k}"), F.lit(0.0)) for k in range(STATES)]).first())


def _started(vocabulary: DataFrame, shards: int) -> Model:
    sums = [F.coalesce(F.sum(name), F.lit(0)) for name in ("tokens", "distinct", "rare", "frequent")]
    tokens, distinct, rare, frequent = vocabulary.agg(*sums).first()
    words = vocabulary.select("shard", "keys", "counts").mapInArrow(_first_shares, _ddl(_WORDS))
    even = np.full(STATES, rare / STATES)
    persistent = np.full((STATES, STATES), (1 - PERSISTENCE) / STATES) + np.eye(STATES) * PERSISTENCE
    parameters = Parameters(
        tokens, distinct, rare, frequent, _total(words) + even, even, np.full(STATES, 1 / STATES), persistent
    )
    return Model(shards, vocabulary, words, parameters)


_TOLD = pa.schema([*_ANSWER, ("shares", pa.binary())])


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each message the shares of its frequent words."""
    own, parts = None, np.empty((0, STATES), "<u2")
    for shard, block, counts, frequent, packed in _rows(batches):
        if block is None:
            own, parts = shard, _unsqueezed(packed, "<u2").reshape(-1, STATES)
        else:
            chosen = parts[_unsqueezed(frequent)] if own == shard else parts[:0]
            yield _batch([(shard, block, counts, frequent, _squeezed(chosen.ravel(), "<u2"))], _TOLD)


def _with_shares(blocks: DataFrame, answers: DataFrame, model: Model):
    """Blocks beside what the shards say of their words."""
    asked = answers.withColumn("shares", F.lit(None).cast("binary"))
    told = _by_shard(model.words.select("shard", "shares"), asked).mapInArrow(_told, _ddl(_TOLD))
    kept = blocks.drop("hashes", "words")
    return kept.groupBy("block").cogroup(told.withColumnRenamed("block", "of").groupBy("of"))


# Recursions.


class _Pieces:
    """Stretches of a block side by side, the longest first: step t holds the t-th token of the first ``active[t]``."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray) -> None:
        self.order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[self.order], lengths[self.order]
        steps = int(lengths[0])
        self.active = np.searchsorted(-lengths, -np.arange(steps), "left")
        self.offsets = np.concatenate([[0], np.cumsum(self.active)])
        self.places = np.concatenate([starts[:n] + t for t, n in enumerate(self.active.tolist())])

    def steps(self) -> Iterator[tuple[int, int]]:
        return zip(self.offsets.tolist(), self.active.tolist(), strict=False)


def _transfers(pieces: _Pieces, tokens: np.ndarray, given: np.ndarray, following: np.ndarray):
    """For each piece and each state of its first token: the states after its last, and the log of the weight."""
    state, logs = None, None
    for t, (offset, n) in enumerate(pieces.steps()):
        now = given[tokens[pieces.places[offset : offset + n]]][:, None, :]
        if t == 0:
            state, logs = np.eye(STATES)[None] * now, np.zeros((n, STATES))
        else:
            state[:n] = (state[:n].reshape(-1, STATES) @ following).reshape(n, STATES, STATES) * now
        if t % _SCALED_EVERY == 0:
            _rescale(state[:n], logs[:n])
    _rescale(state, logs)
    back = np.argsort(pieces.order)
    return state[back], logs[back]


def _rescale(state: np.ndarray, logs: np.ndarray) -> None:
    total = state.sum(axis=-1)
    state /= total[..., None]
    logs += np.log(total)


def _likelihoods(pieces: _Pieces, tokens: np.ndarray, given: np.ndarray, first: np.ndarray, following: np.ndarray):
    """Natural logs of the probabilities of whole sequences."""
    state, logs = None, None
    for t, (offset, n) in enumerate(pieces.steps()):
        now = given[tokens[pieces.places[offset : offset + n]]]
        if t == 0:
            state, logs = first * now, np.zeros(n)
        else:
            state[:n] = (state[:n] @ following) * now
        if t % _SCALED_EVERY == 0:
            _rescale(state[:n], logs[:n])
    _rescale(state, logs)
    return logs[np.argsort(pieces.order)]


class _Sequences:
    """The documents of a block as pieces, those of long documents joined by their transfer matrices."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, given: np.ndarray, parameters: Parameters) -> None:
        self.tokens, self.lengths, self.given, self.parameters = tokens, lengths, given, parameters
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        by_length = np.argsort(lengths, kind="stable")
        self.short = by_length[lengths[by_length] <= LONG]
        self.long = np.flatnonzero(lengths > LONG)
        starts = [np.arange(self.starts[d], self.ends[d], PIECE) for d in self.long.tolist()]
        # The pieces of the k-th long document are those from bounds[k] on.
        self.bounds = np.cumsum([0, *map(len, starts)])
        self.cuts = np.concatenate([*starts, np.empty(0, np.int64)])
        ends = np.repeat(self.ends[self.long], np.diff(self.bounds))
        self.sizes = np.minimum(ends - self.cuts, PIECE)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Log probabilities of the long documents; of each piece the states before and after it, and weights from
        its first token on."""
        p = self.parameters
        parts = [(np.empty((0, STATES, STATES)), np.empty((0, STATES)))]
        for at in range(0, len(self.cuts), _PIECES_AT_ONCE):
            some = slice(at, at + _PIECES_AT_ONCE)
            parts.append(_transfers(_Pieces(self.cuts[some], self.sizes[some]), self.tokens, self.given, p.following))
        state, logs = (np.concatenate(x) for x in zip(*parts, strict=True))
        most = logs.max(axis=1, initial=-np.inf)
        weight = np.exp(logs - most[:, None])
        before, after, onward = np.empty((3, len(state), STATES))
        total = np.zeros(len(self.long))
        for k in range(len(self.long)):
            pieces = range(self.bounds[k], self.bounds[k + 1])
            entering = p.first
            for at in pieces:
                before[at] = entering
                leaving = (entering * weight[at]) @ state[at]
                total[k] += most[at] + np.log(leaving.sum())
                after[at] = leaving / leaving.sum()
                entering = after[at] @ p.following
            rest = np.ones(STATES)
            for at in reversed(pieces):
                onward[at] = weight[at] * (state[at] @ rest)
                onward[at] /= onward[at].max()
                rest = p.following @ onward[at]
        return total, before, after, onward

    def log10(self) -> np.ndarray:
        result = np.zeros(len(self.lengths))
        p = self.parameters
        for some in _by_tokens(self.lengths[self.short]):
            chosen = self.short[some]
            pieces = _Pieces(self.starts[chosen], self.lengths[chosen])
            result[chosen] = _likelihoods(pieces, self.tokens, self.given, p.first, p.following)
        result[self.long] = self.joined()[0]
        # A sum of ones may round to more than one.
        return np.minimum(result, 0) / np.log(10)

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of each word in each state, of first states and of transitions."""
        p = self.parameters
        words = np.zeros((len(self.given), STATES))
        given = self.given.astype(np.float32)
        first, following = np.zeros(STATES), np.zeros((STATES, STATES))
        _, before, after, onward = self.joined()
        # All pieces but the last of a document lead on to the next.
        leads = np.ones(len(self.cuts), bool)
        leads[self.bounds[1:] - 1] = False
        at = np.flatnonzero(leads)
        crossing = after[at][:, :, None] * p.following * onward[at + 1][:, None, :]
        following += (crossing / crossing.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beyond = np.ones_like(after)
        beyond[at] = onward[at + 1] @ p.following.T
        beyond /= (after * beyond).sum(axis=1, keepdims=True)
        starts = np.concatenate([self.starts[self.short], self.cuts])
        lengths = np.concatenate([self.lengths[self.short], self.sizes])
        n = len(self.short)
        entering = np.concatenate([np.broadcast_to(p.first, (n, STATES)), before])
        rest = np.concatenate([np.ones((n, STATES)), beyond])
        opening = np.concatenate([np.ones(n, bool), np.isin(np.arange(len(self.cuts)), self.bounds[:-1])])
        for some in _by_tokens(lengths):
            pieces = _Pieces(starts[some], lengths[some])
            chosen = some[pieces.order]
            visits, moves, opened = _smoothed(
                pieces, self.tokens, given, p.following, entering[chosen], rest[chosen], opening[chosen]
            )
            local = self.tokens[pieces.places].astype(np.int64)
            for k in range(STATES):
                words[:, k] += np.bincount(local, weights=visits[:, k], minlength=len(words))
            following += moves
            first += opened
        return words, first, following


def _by_tokens(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of sequences of about ``AT_ONCE`` tokens, the unit that is worked on at once."""
    if len(lengths):
        group = (np.cumsum(lengths) - lengths) // AT_ONCE
        for chosen in np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(group)) + 1):
            yield chosen


def _smoothed(pieces, tokens, given, following, entering, rest, opening):
    """Forward and backward over pieces: state probabilities of each token, moves, and those of opening tokens.

    Single precision: the sums it goes into are expected counts, not results.
    """
    emitted = given[tokens[pieces.places]]
    follow = following.astype(np.float32)
    ahead = np.empty_like(emitted)
    totals = np.empty(len(emitted), np.float32)
    steps = list(pieces.steps())
    last = 0
    for t, (offset, n) in enumerate(steps):
        now = ahead[offset : offset + n]
        if t:
            np.matmul(ahead[last : last + n], follow, out=now)
        else:
            now[:] = entering
        now *= emitted[offset : offset + n]
        total = now.sum(axis=1)
        totals[offset : offset + n] = total
        now /= total[:, None]
        last = offset
    behind = np.empty_like(emitted)
    moves = np.zeros((STATES, STATES))
    done = 0
    for t in range(len(steps) - 1, -1, -1):
        offset, n = steps[t]
        if done:
            after = steps[t + 1][0]
            onward = emitted[after : after + done] * behind[after : after + done]
            onward /= totals[after : after + done, None]
            moves += ahead[offset : offset + done].T @ onward
            np.matmul(onward, follow.T, out=behind[offset : offset + done])
        behind[offset + done : offset + n] = rest[done:n]
        done = n
    ahead *= behind
    opened = ahead[: steps[0][1]][opening].sum(axis=0, dtype=float)
    return ahead, moves * following, opened


# Training and scores.


class _Met:
    """A block with what the shards say: counts and probabilities of its words, its documents as sequences."""

    def __init__(self, left: pa.Table, right: pa.Table, parameters: Parameters) -> None:
        self.row = left.to_pylist()[0]
        order = _unsqueezed(self.row["order"])
        messages = sorted(right.to_pylist(), key=lambda row: row["shard"])
        counts = [_unsqueezed(message["counts"], "<i8") for message in messages]
        # By shard, in the order of the hashes: which words are frequent, by their numbers here.
        ends = np.cumsum([len(part) for part in counts])
        self.counts = np.empty(len(order), np.int64)
        self.counts[order] = np.concatenate(counts)
        self.shards = [message["shard"] for message in messages]
        self.frequent = [message["frequent"] for message in messages]
        self.places = [
            np.flatnonzero(part >= LEAST_COUNT) + end - len(part) for part, end in zip(counts, ends, strict=True)
        ]
        self.local = order[np.concatenate(self.places)]
        shares = np.concatenate([_shares(message["shares"]) for message in messages])
        given = parameters.emissions(self.counts, self.local, shares)
        lengths = _unsqueezed(self.row["lengths"]).astype(np.int64)
        self.sequences = _Sequences(_unsqueezed(self.row["tokens"]), lengths, given, parameters)


_COUNTS = pa.schema([("shard", pa.int32()), ("frequent", pa.binary()), ("n", pa.binary()), ("shares", pa.binary())])


def _expectations(parameters: Parameters):
    """Expected counts of a block: a row for each shard, and one for rare words, first states and transitions."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        met = _Met(left, right, parameters)
        words, first, following = met.sequences.expected()
        numbers = _unsqueezed(met.row["n"])
        rows, at = [], 0
        for shard, frequent, places in zip(met.shards, met.frequent, met.places, strict=True):
            if len(places):
                own = words[met.local[at : at + len(places)]]
                rows.append((shard, frequent, _squeezed(numbers[places]), _packed_shares(own)))
                at += len(places)
        rare = words[met.counts < LEAST_COUNT].sum(axis=0)
        sums = np.concatenate([rare[None], first[None], following])
        rows.append((-1 - met.row["block"] % _SPREAD, b"", b"", sums.tobytes()))
        return pa.Table.from_batches([_batch(rows, _COUNTS)])

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the messages to each shard, from messages sorted by shard."""
    for shard, messages in groupby(_rows(batches), key=lambda row: row[0]):
        if shard < 0:
            total = sum(np.frombuffer(message[3], float) for message in messages)
            yield _batch([(shard, total.tobytes(), *[0.0] * STATES)], _WORDS)
            continue
        expected, counts = np.zeros((0, STATES)), np.zeros(0)
        for _, frequent, n, shares in messages:
            at, numbers = _unsqueezed(frequent), _unsqueezed(n)
            more = int(at[-1]) + 1 - len(expected)
            if more > 0:
                expected = np.concatenate([expected, np.zeros((more, STATES))])
                counts = np.concatenate([counts, np.zeros(more)])
            expected[at] += numbers[:, None] * _shares(shares)
            counts[at] += numbers
        yield _words_row(shard, expected, counts)


def _improved(training: DataFrame, answers: DataFrame, model: Model) -> Model:
    """One round of Baum-Welch over all training blocks."""
    counts = _with_shares(training, answers, model).applyInArrow(_expectations(model.parameters), _ddl(_COUNTS))
    gathered = counts.repartition("shard").sortWithinPartitions("shard").mapInArrow(_gathered, _ddl(_WORDS))
    told = stored(gathered, "hmm-words")
    small = sum(np.frombuffer(row["shares"], float) for row in told.where("shard < 0").collect()).reshape(-1, STATES)
    words = told.where("shard >= 0")
    rare, first, moves = small[0], small[1] + 1, small[2:] + 1
    parameters = replace(
        model.parameters,
        # No state dies out.
        totals=np.maximum(_total(words) + rare, 1e-6),
        rare=np.maximum(rare, 1e-9),
        first=first / first.sum(),
        following=moves / moves.sum(axis=1, keepdims=True),
    )
    return replace(model, words=words, parameters=parameters)


@dataclass(frozen=True)
class Prepared:
    """Stored blocks of documents, what the vocabulary says of their words, and the vocabulary."""

    blocks: DataFrame
    answers: DataFrame
    vocabulary: DataFrame
    shards: int


def prepared(documents: DataFrame, model: Model | None = None) -> Prepared:
    """Blocks of the documents, with the vocabulary of a model or that of their training part."""
    ship_code(documents.sparkSession)
    blocks = stored(blocks_of(documents), "hmm-blocks")
    if model:
        vocabulary, shards = model.vocabulary, model.shards
    else:
        words = blocks.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
        shards = max(1, math.ceil(words / SHARD_WORDS))
        vocabulary = stored(vocabulary_of(blocks, shards), "hmm-vocabulary")
    return Prepared(blocks, stored(counts_of(blocks, vocabulary, shards), "hmm-answers"), vocabulary, shards)


def trained(given: Prepared) -> Model:
    """The model of the blocks that are not held out."""
    model = _started(given.vocabulary, given.shards)
    if model.parameters.tokens:
        training = given.blocks.where("NOT held_out")
        answers = given.answers.join(training.select("block"), "block", "left_semi").select(given.answers.columns)
        for _ in range(ROUNDS):
            model = _improved(training, answers, model)
    return model


def scored(given: Prepared, model: Model) -> DataFrame:
    ddl = ", ".join(f"{name} {kind}" for name, kind in _SCORES)
    return _with_shares(given.blocks, given.answers, model).applyInArrow(_score(model.parameters), ddl)


_SCORES = [
    ("doc_id", "long"),
    ("held_out", "boolean"),
    ("n_tokens", "long"),
    ("n_known", "long"),
    ("train_tokens", "long"),
    ("base_score", "double"),
    ("score", "double"),
]


def _score(parameters: Parameters):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        met = _Met(left, right, parameters)
        tokens, starts = met.sequences.tokens, met.sequences.starts
        words = np.log10(parameters.unigram(met.counts))[tokens]
        known = (met.counts > 0)[tokens].astype(np.int64)
        n = len(starts)
        columns = [
            pa.array(met.row["doc_ids"], pa.int64()),
            pa.array([met.row["held_out"]] * n, pa.bool_()),
            met.sequences.lengths,
            np.add.reduceat(known, starts),
            np.full(n, parameters.tokens),
            np.add.reduceat(words, starts),
            met.sequences.log10(),
        ]
        return pa.table(columns, names=[name for name, _ in _SCORES])

    return run


def train(documents: DataFrame) -> Model:
    """The model of the documents that are not held out."""
    return trained(prepared(documents))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Scores of any documents by a model."""
    return scored(prepared(documents, model), model)


def language_scores(documents: DataFrame) -> DataFrame:
    """A row for each document: its log10 probability by its unigrams and by the model, trained on those not held out."""
    given = prepared(documents)
    return scored(given, trained(given))
