"""Repeated byte strings across documents, found by a logarithmic family of suffix arrays.

Removed is each byte covered by a string of ``LENGTH`` bytes that also starts in a document of
a smaller id. Four steps, each over the whole corpus, with shuffles of packed arrays:

1. *Anchors.* Of the suffixes of a document those are kept whose first ``SEED`` bytes have the
   least hash in some window of ``LENGTH`` bytes: every window has one, equal windows
   the same, and about one suffix in eighteen remains.
2. *Seeds.* Suffixes go to buckets by their seed. A bucket takes its documents in batches of
   rising ids; each batch is sorted and scanned against the levels of an index of the
   seeds before it (``Levels``). Levels of like size merge, so there are logarithmically many.
   What meets nothing of another document is dropped: most of the corpus.
3. *Suffixes.* The survivors return to their documents for the bytes around them, and go to
   buckets again. A bucket's batch is the suffix array of all windows around its
   anchors, down to ``LENGTH`` bytes, in the order of a fingerprint of these bytes; it is
   merge-scanned against the levels of such arrays before it. A window that is there, or
   in an earlier document of its batch, is a repeat; new ones become a level.
4. *Removal.* Repeats return to their documents as byte spans and are cut out.

A bucket holds distinct seeds or windows and one batch, however often one of them occurs. Fingerprints are compared
together with the hash of the seed: 112 bits that two different windows would have to share.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import groups, mixed

LENGTH, SEED = 50, 16
WINDOWS = LENGTH - SEED + 1  # seeds in a window, and windows around a seed
BATCHES = 8
# Bytes of text for each bucket and for each group of documents.
BUCKET_BYTES, GROUP_BYTES = 10_000_000, 8_000_000
# A longer document is hashed in segments of this size.
_SEGMENT = 4_000_000
_U = np.uint64


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two and eight bytes from each place on, as numbers."""
    one = data.astype(_U)
    two = (one[:-1] << _U(8)) | one[1:]
    four = (two[:-2] << _U(16)) | two[2:]
    return two, (four[:-4] << _U(32)) | four[4:]


def _sixteen(eight: np.ndarray) -> np.ndarray:
    return mixed(mixed(eight[:-8] * _U(0x9E3779B97F4A7C15)) + eight[8:])


def fingerprints(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``LENGTH`` bytes from each place on."""
    two, eight = _words(data)
    sixteen = _sixteen(eight)
    thirty_two = mixed(sixteen[:-16] * _U(0xC2B2AE3D27D4EB4F) + sixteen[16:])
    n = len(data) - LENGTH + 1
    rest = mixed(sixteen[32 : 32 + n] * _U(0x165667B19E3779F9) + two[48 : 48 + n])
    return mixed(thirty_two[:n] * _U(0x9E3779B97F4A7C15) + rest)


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """Least (or greatest) of each ``width`` neighbours, by doubling."""
    found, step = values, 1
    n = len(values) - width + 1
    while 2 * step <= width:
        found = least(found[:-step], found[step:])
        step *= 2
    return least(found[:n], found[width - step : width - step + n])


def seeds_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each seed, and least hash of each window; both empty for a text below ``LENGTH``."""
    if len(data) < LENGTH:
        return np.zeros(0, _U), np.zeros(0, _U)
    hashes = _sixteen(_words(data)[1])
    return hashes, _sliding(hashes, WINDOWS, np.minimum)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the seeds that are the least of some window."""
    found = []
    for begin in range(0, max(1, len(data) - LENGTH + 1), _SEGMENT):
        hashes, least = seeds_of(data[begin : begin + _SEGMENT + LENGTH - 1])
        if not len(least):
            continue
        edge = np.zeros(WINDOWS - 1, _U)
        most = _sliding(np.concatenate([edge, least, edge]), WINDOWS, np.maximum)
        at = np.flatnonzero(hashes == most)
        found.append((hashes[at], at + begin))
    if not found:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    hashes, at = (np.concatenate(part) for part in zip(*found, strict=True))
    at, first = np.unique(at, return_index=True)
    return hashes[first], at


def surroundings(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor, where the first and the last window begin that it is the least seed of."""
    first, last = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
    for begin in range(0, max(1, len(data) - LENGTH + 1), _SEGMENT):
        # Windows of the segment; a little more of the text around gives every anchor its seed.
        low, high = begin, min(begin + _SEGMENT, len(data) - LENGTH + 1)
        own = np.flatnonzero((at >= low) & (at < high + WINDOWS - 1))
        if not len(own):
            continue
        hashes, least = seeds_of(data[low : high + LENGTH - 1])
        for k in range(0, len(own), 100_000):
            part = own[k : k + 100_000]
            window = at[part, None] - low - np.arange(WINDOWS - 1, -1, -1)
            inside = (window >= 0) & (window < len(least))
            clipped = np.clip(window, 0, len(least) - 1)
            mine = inside & (least[clipped] == hashes[at[part] - low][:, None])
            some = mine.any(axis=1)
            begins = window[np.arange(len(part)), mine.argmax(axis=1)] + low
            ends = window[np.arange(len(part)), WINDOWS - 1 - mine[:, ::-1].argmax(axis=1)] + low
            new = some & (last[part] < 0)
            first[part[new]] = begins[new]
            last[part[some]] = ends[some]
    return first, last


class Levels:
    """A logarithmic family of sorted arrays: like sizes merge, so each entry moves O(log n) times."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, ...]] = []

    def add(self, key: np.ndarray, *payload: np.ndarray) -> None:
        """A new level, sorted by key."""
        level = (key, *payload)
        while self.levels and len(self.levels[-1][0]) <= 2 * len(level[0]):
            older = self.levels.pop()
            joined = [np.concatenate(parts) for parts in zip(older, level, strict=True)]
            order = np.argsort(joined[0], kind="stable")
            level = tuple(part[order] for part in joined)
        if len(level[0]):
            self.levels.append(level)

    def scan(self, key: np.ndarray) -> Iterator[tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]]:
        """For each level: itself and, for each of the sorted keys, where its entries begin and end there."""
        for level in self.levels:
            yield level, np.searchsorted(level[0], key, "left"), np.searchsorted(level[0], key, "right")


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all the ranges, one after the other."""
    count = end - begin
    return np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())


# Arrays travel as bytes, those of one rank side by side, so that the store's codec can do its work.


def _pack(values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpack(cells: pa.ChunkedArray, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    parts = [np.frombuffer(c, np.uint8).reshape(size, -1).T for c in cells.to_pylist()]
    return np.ascontiguousarray(np.concatenate(parts)).view(kind).reshape(-1)


def _rows(key: np.ndarray, columns: list[np.ndarray]) -> list[tuple]:
    """One row for each distinct key: the key and the packed arrays."""
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    return [(int(key[own[0]]), *(_pack(c[own]) for c in columns)) for own in np.split(order, cuts) if len(own)]


def _anchor_rows(buckets: int, bounds: list[int]):
    limits = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for id_, nth, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if id_ is None or not text:
                    continue
                hashes, at = anchors(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))
                if len(at):
                    held.append((hashes, np.full(len(at), id_, np.int64), at + (nth << 32)))
                    size += len(at)
                if size > 1_500_000:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def flush(held: list[tuple]) -> pa.RecordBatch:
        hashes, ids, places = (np.concatenate(part) for part in zip(*held, strict=True))
        bucket = (hashes % _U(buckets)).astype(np.int64)
        key = bucket * BATCHES + np.searchsorted(limits, ids, "right")
        rows = _rows(key, [hashes, ids, places])
        key, *packed = zip(*rows, strict=True)
        key = np.array(key)
        return pa.RecordBatch.from_arrays(
            [pa.array(key // BATCHES, pa.int32()), pa.array(key % BATCHES, pa.int32())]
            + [pa.array(p, pa.binary()) for p in packed],
            ["bucket", "batch", "seeds", "ids", "places"],
        )

    return run


ANCHOR_SCHEMA = "bucket int, batch int, seeds binary, ids binary, places binary"


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table]]:
    """The rows of each (bucket, batch), batches rising; whether a new bucket begins."""
    bucket = None
    for group in groups(batches, ["bucket", "batch"]):
        own = group.column("bucket")[0].as_py()
        yield own != bucket, group
        bucket = own


def _survivor_rows(parts: int):
    """Anchors whose seed is in another document too, to the groups of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Levels()
        for new, group in _by_bucket(batches):
            if new:
                index = Levels()
            seed, id_ = _unpack(group.column("seeds"), "<u8"), _unpack(group.column("ids"), "<i8")
            place = _unpack(group.column("places"), "<i8")
            order = np.lexsort((place, id_, seed))
            seed, id_, place = seed[order], id_[order], place[order]
            start = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
            stop = np.concatenate([start[1:], [len(seed)]])
            own, several = seed[start], id_[start] != id_[stop - 1]
            known = np.zeros(len(own), bool)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for (_, ids, places, told), low, high in index.scan(own):
                known |= high > low
                # The first document of a seed is told when the second one comes.
                first = _ranges(low, high)
                first = first[~told[first]]
                told[first] = True
                found.append((ids[first], places[first]))
            hit = known | several
            of = np.repeat(np.arange(len(own)), stop - start)
            found.append((id_[hit[of]], place[hit[of]]))
            fresh = ~known[of] & (~several[of] | (np.arange(len(seed)) == start[of]))
            index.add(seed[fresh], id_[fresh], place[fresh], several[of][fresh].copy())
            ids, places = (np.concatenate(part) for part in zip(*found, strict=True))
            if len(ids):
                rows = _rows(ids % parts, [ids, places])
                part, packed_ids, packed_places = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array(packed_ids, pa.binary()), pa.array(packed_places, pa.binary())],
                    ["part", "ids", "places"],
                )

    return run


SURVIVOR_SCHEMA = "part int, ids binary, places binary"


def _documents(table: pa.Table) -> dict[tuple[int, int], bytes]:
    """Text by (id, number among the rows of that id); rows without an id are left out."""
    return {
        (id_, nth): (text or "").encode("utf-8", "surrogatepass")
        for id_, nth, text in zip(*(table.column(c).to_pylist() for c in ("doc_id", "nth", "text")), strict=True)
        if id_ is not None
    }


def _by_document(rows: pa.Table, columns: dict[str, str]) -> Iterator[tuple[tuple[int, int], list[np.ndarray]]]:
    """The unpacked columns (the first two are ids and places), document by document."""
    if not rows.num_rows:
        return
    ids, places, *others = (_unpack(rows.column(name), kind) for name, kind in columns.items())
    order = np.lexsort((places, ids))
    ids, places, others = ids[order], places[order], [o[order] for o in others]
    nth = places >> 32
    cuts = np.flatnonzero((np.diff(ids) != 0) | (np.diff(nth) != 0)) + 1
    for own in np.split(np.arange(len(ids)), cuts):
        yield (int(ids[own[0]]), int(nth[own[0]])), [places[own] & 0xFFFFFFFF, *(o[own] for o in others)]


def _suffix_rows(buckets: int, bounds: list[int]):
    """The bytes of the windows around each survivor, to the buckets."""
    limits = np.array(bounds, np.int64)

    def run(texts: pa.Table, survivors: pa.Table) -> pa.Table:
        documents = _documents(texts)
        squeeze = zstandard.ZstdCompressor(level=1)
        found: list[tuple] = []
        stretches: list[np.ndarray] = []
        for (id_, nth), (at,) in _by_document(survivors, {"ids": "<i8", "places": "<i8"}):
            data = np.frombuffer(documents[id_, nth], np.uint8)
            at = np.unique(at)
            first, last = surroundings(data, at)
            own = last >= first
            at, first, last = at[own], first[own], last[own]
            size = last - first + LENGTH
            seed = _sixteen_at(data, at)
            found.append((seed, np.full(len(at), id_, np.int64), first + (nth << 32), size, at - first))
            stretches.append(data[_ranges(first, first + size)])
        if not found:
            return _SUFFIX_SCHEMA.empty_table()
        seed, ids, places, size, offset = (np.concatenate(part) for part in zip(*found, strict=True))
        data = np.concatenate(stretches)
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        bucket = (seed % _U(buckets)).astype(np.int64)
        key = bucket * BATCHES + np.searchsorted(limits, ids, "right")
        # Equal stretches together, so that they compress; within them by document.
        order = np.lexsort((ids, size, offset, seed, key))
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        rows = []
        for own in np.split(order, cuts):
            rows.append(
                {
                    "bucket": int(key[own[0]] // BATCHES),
                    "batch": int(key[own[0]] % BATCHES),
                    "seeds": _pack(seed[own]),
                    "ids": _pack(ids[own]),
                    "places": _pack(places[own]),
                    "sizes": _pack(size[own].astype(np.uint8)),
                    "bytes": squeeze.compress(data[_ranges(begin[own], begin[own] + size[own])].tobytes()),
                }
            )
        return pa.Table.from_pylist(rows, _SUFFIX_SCHEMA)

    return run


def _sixteen_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the seeds at some places."""
    seeds = data[at[:, None] + np.arange(SEED)].astype(_U)
    eight = np.zeros((2, len(at)), _U)
    for k in range(SEED):
        eight[k // 8] = (eight[k // 8] << _U(8)) | seeds[:, k]
    return mixed(mixed(eight[0] * _U(0x9E3779B97F4A7C15)) + eight[1])


_SUFFIX_SCHEMA = pa.schema(
    [
        ("bucket", pa.int32()),
        ("batch", pa.int32()),
        ("seeds", pa.binary()),
        ("ids", pa.binary()),
        ("places", pa.binary()),
        ("sizes", pa.binary()),
        ("bytes", pa.binary()),
    ]
)
SUFFIX_SCHEMA = "bucket int, batch int, seeds binary, ids binary, places binary, sizes binary, bytes binary"


def _repeat_rows(parts: int):
    """Spans of the windows that occur in an earlier document, to the groups of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, expand = Levels(), zstandard.ZstdDecompressor()
        for new, group in _by_bucket(batches):
            if new:
                index = Levels()
            seed, id_ = _unpack(group.column("seeds"), "<u8"), _unpack(group.column("ids"), "<i8")
            place, size = _unpack(group.column("places"), "<i8"), _unpack(group.column("sizes"), "u1").astype(np.int64)
            data = b"".join(map(expand.decompress, group.column("bytes").to_pylist()))
            data = np.frombuffer(data, np.uint8)
            count = size - LENGTH + 1
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            of = np.repeat(np.arange(len(size)), count)
            print_ = fingerprints(data)[_ranges(begin, begin + count)]
            # The suffix array of the batch: windows in order, equal ones by document.
            print_ = mixed(print_ ^ seed[of])
            order = np.lexsort((id_[of], print_))
            print_, owner = print_[order], of[order]
            start = np.flatnonzero(np.concatenate([[True], print_[1:] != print_[:-1]]))
            run_of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(print_))))
            known = np.zeros(len(start), bool)
            for _, low, high in index.scan(print_[start]):
                known |= high > low
            repeat = known[run_of] | (id_[owner] > id_[owner[start]][run_of])
            index.add(print_[start][~known])
            hit = np.zeros(len(of), bool)
            hit[order[repeat]] = True
            # Runs of neighbouring windows of one stretch are one span.
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            nth = at - np.concatenate([[0], np.cumsum(count)[:-1]])[of[at]]
            opens = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(of[at]) != 0)])
            closes = np.concatenate([opens[1:], [True]])
            own = of[at[opens]]
            low, length = place[own] + nth[opens], nth[closes] - nth[opens] + LENGTH
            rows = _rows(id_[own] % parts, [id_[own], low, length])
            part, *packed = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), *(pa.array(p, pa.binary()) for p in packed)],
                ["part", "ids", "places", "lengths"],
            )

    return run


REPEAT_SCHEMA = "part int, ids binary, places binary, lengths binary"


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    opens = np.concatenate([[True], begin[1:] > end[:-1]])
    return begin[opens], end[np.concatenate([opens[1:], [True]])]


def _cut(with_bytes: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept" if with_bytes else "kept_sha256"]
    kinds = [pa.int64()] * 4 + [pa.binary() if with_bytes else pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(texts: pa.Table, repeats: pa.Table) -> pa.Table:
        kinds_ = {"ids": "<i8", "places": "<i8", "lengths": "<i8"}
        spans = {key: merged(at, at + size) for key, (at, size) in _by_document(repeats, kinds_)}
        rows: list[tuple] = []
        for id_, nth, text in zip(*(texts.column(c).to_pylist() for c in ("doc_id", "nth", "text")), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            begin, end = spans.get((id_, nth), ((), ()))
            kept, at = [], 0
            for low, high in zip(begin, end, strict=True):
                kept.append(data[at:low])
                at = high
            kept = b"".join([*kept, data[at:]])
            told = kept if with_bytes else hashlib.sha256(kept).hexdigest()
            rows.append((id_, len(data), len(data) - len(kept), len(begin), told))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, schema.types, strict=True)], schema=schema
        )

    return run


def _uncut(with_bytes: bool):
    cut = _cut(with_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.Table.from_batches([batch])
            yield from cut(texts, texts.slice(0, 0)).to_batches()

    return run


def _prime(least: int) -> int:
    """The first odd prime from ``least`` on: ids that rise in steps fill all of so many groups alike."""
    while least < 3 or any(least % k == 0 for k in range(2, math.isqrt(least) + 1)):
        least += 1
    return least


def without_repeats(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and ``kept_sha256`` (or the bytes, ``kept``) of every row.

    A null text is empty. Rows without an id keep all and are no source of repeats. Rows that
    share an id are one document: they do not repeat each other. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if shared.isEmpty():
        docs = docs.withColumn("nth", F.lit(0).cast("long"))
    else:
        again = docs.join(shared.select("doc_id"), "doc_id", "left_semi").distinct()
        again = again.selectExpr("doc_id", "text", "row_number() OVER (PARTITION BY doc_id ORDER BY text) - 1L AS nth")
        same = F.expr("d.doc_id = a.doc_id AND d.text <=> a.text")
        docs = docs.alias("d").join(again.alias("a"), same, "left")
        docs = docs.selectExpr("d.doc_id", "d.text", "coalesce(a.nth, 0L) AS nth")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    buckets = max(2 * cores, math.ceil(total / BUCKET_BYTES))
    parts = _prime(max(2 * cores, math.ceil(total / GROUP_BYTES)))
    # Batches of rising ids, about as many documents each.
    ids = docs.where("doc_id IS NOT NULL")
    quantiles = ids.approxQuantile("doc_id", [k / BATCHES for k in range(1, BATCHES)], 0.01) if total else []
    bounds = sorted({int(q) for q in quantiles})

    rows = docs.select("doc_id", "nth", "text")
    found = rows.mapInArrow(_anchor_rows(buckets, bounds), ANCHOR_SCHEMA)
    found = found.repartition(buckets, "bucket").sortWithinPartitions("bucket", "batch")
    survivors = found.mapInArrow(_survivor_rows(parts), SURVIVOR_SCHEMA)
    # The same shuffle of the texts serves both returns to the documents.
    grouped = rows.where("doc_id IS NOT NULL").withColumn("part", F.expr(f"int(pmod(doc_id, {parts}))"))
    suffixes = grouped.groupBy("part").cogroup(survivors.groupBy("part"))
    suffixes = suffixes.applyInArrow(_suffix_rows(buckets, bounds), SUFFIX_SCHEMA)
    suffixes = suffixes.repartition(buckets, "bucket").sortWithinPartitions("bucket", "batch")
    repeats = suffixes.mapInArrow(_repeat_rows(parts), REPEAT_SCHEMA)
    last = "kept binary" if with_bytes else "kept_sha256 string"
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}"
    result = grouped.groupBy("part").cogroup(repeats.groupBy("part")).applyInArrow(_cut(with_bytes), schema)
    # Rows without an id need no group: all of them in one would be more than a task can hold.
    return result.union(rows.where("doc_id IS NULL").mapInArrow(_uncut(with_bytes), schema))
