"""Repeated byte strings across documents, from merged Burrows-Wheeler transforms.

Removes each byte covered by a string of ``length`` bytes that also starts in a
document with a smaller id. Of equal whole texts only the smallest document's is
searched; its copies lose everything. Work is laid out so that all places of one
repeated string meet in one task, and little else does:

1. Every string (window) of ``length`` bytes has an *anchor*: its ``K``-gram with the
   smallest hash, the leftmost of equals. It depends on the window alone, and the
   windows of one anchor are neighbours: together they are its *segment*. Anchors
   are counted per bucket of documents, and those in two or more documents are
   candidates.
2. The segments of candidate anchors are collected per bucket, equal ones once,
   with the smallest document; other documents of the bucket with an equal
   segment know already that it repeats. The rest goes to the anchor's task. An
   anchor of very many documents (``HOT``) sends single windows instead, each to
   the task of its own bytes, so that no task gets all their different segments.
3. The segments of a task are cut into shards. Each shard's cyclic suffixes are
   sorted and stored as a Burrows-Wheeler transform (two bytes to a symbol). The
   transforms are merged by refining their interleave: one stable distribution
   by symbol per step sorts the merged suffixes by two more bytes, without
   comparing suffixes of different shards. The blocks that agree so far are kept
   with it; after ``length / 2`` steps they are the intervals with a common prefix of
   ``length`` or more, and the smallest document in each decides its windows.
4. The covered ranges go back to the documents' buckets.

Ids must be integers. Null texts count as empty; texts shorter than ``length``
lose nothing. Rows with a null id match nothing and keep all their bytes. Rows
that repeat an id are judged each by its own text and never match each other; those
that repeat id and text are searched once. A row is known by 128 bits of the SHA-256 of
both. Very long texts are searched in overlapping parts; an empty table gives no rows;
columns other than id and text are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare_workers, stored, table

LENGTH = 50
#: Bytes of an anchor.
K = 20
#: Text of one bucket of documents, in bytes.
BUCKET_BYTES = 8_000_000
#: An anchor in more documents than this is split by the content of its windows.
HOT = 2_000
#: Segment bytes that are merged at once (more only where one anchor has more), and shards of them.
MERGE_BYTES = 1_000_000
SHARDS = 6
#: Windows handled at once when anchors are sought.
PIECE = 1 << 16

_rng = np.random.RandomState(977)
_BYTE = _rng.randint(0, 1 << 31, 256).astype(np.uint32) * np.uint32(2) + _rng.randint(0, 2, 256).astype(np.uint32)
_ODD = np.uint32(0x9E3779B1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x9E3779B97F4A7C15)


# -- anchors --------------------------------------------------------------


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams."""
    h, n, done, size = _BYTE[data], 1, None, 0
    powers = {1: _ODD}
    with np.errstate(over="ignore"):
        while n <= k:
            if k & n:
                done = h if done is None else h[: len(done) - n] * np.uint32(pow(int(_ODD), size, 1 << 32)) + done[n:]
                size += n
            p = powers.setdefault(n, np.uint32(pow(int(_ODD), n, 1 << 32)))
            if 2 * n <= k:
                h = h[: len(h) - n] * p + h[n:]
            n *= 2
        done = (done ^ (done >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        return done ^ (done >> np.uint32(13))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[: len(x) - n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


def _hash_at(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the ``size`` bytes at each position."""
    cells = np.zeros((len(at), -(-size // 8) * 8), np.uint8)
    cells[:, :size] = data[at[:, None] + np.arange(size)]
    h = np.full(len(at), size, np.uint64)
    for column in cells.view(np.uint64).T:
        h = (h ^ column) * _STEP
        h = (h ^ (h >> np.uint64(29))) * _MIX
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def anchors(texts: list[bytes], length: int = LENGTH, k: int = K) -> Iterator[tuple]:
    """Pieces ``(data, row, first, last, hash)``: an anchor's text number and its first and last window (positions in ``data``)
    with ``base``, what a position of each row starts from."""
    for data, bounds in _pieces(texts, length):
        n = len(data)
        if n < length:
            continue
        key = (_gram_hashes(data, k).astype(np.uint64) << np.uint64(32)) | np.arange(n - k + 1, dtype=np.uint64)
        chosen = (_sliding_min(key, length - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        inside = np.ones(n - length + 1, bool)
        for _, _, end in bounds[:-1]:  # windows that run over a text's end
            inside[max(0, end - length + 1) : end] = False
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        p = chosen[at]
        new = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        first, last = at[new], at[np.concatenate([new[1:] - 1, [len(at) - 1]])]
        ends = np.array([e for _, _, e in bounds])
        which = np.searchsorted(ends, first, side="right")
        rows, offsets = np.array([r for r, _, _ in bounds])[which], np.array([o for _, o, _ in bounds])[which]
        yield data, rows, first, last, _hash_at(data, p[new], k), offsets


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Concatenated texts, about ``PIECE`` bytes at a time, as ``(row, text position - data position, end)``; longer texts in overlapping parts."""
    parts, bounds, size = [], [], 0
    for row, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PIECE):
            part = t[at : at + PIECE + length - 1]
            if len(part) < length:
                continue
            if size and size + len(part) > PIECE + length:
                yield np.frombuffer(b"".join(parts), np.uint8), bounds
                parts, bounds, size = [], [], 0
            parts.append(part)
            bounds.append((row, at - size, size + len(part)))
            size += len(part)
    if size:
        yield np.frombuffer(b"".join(parts), np.uint8), bounds


# -- Burrows-Wheeler transforms -------------------------------------------


class Shard:
    """Cyclic suffixes of some strings in the order of their first ``length`` bytes or more, and their transform."""

    def __init__(self, strings: list[bytes], length: int):
        text = np.frombuffer(b"".join(strings), np.uint8)
        sizes = np.array([len(s) for s in strings])
        starts = np.cumsum(sizes) - sizes
        n = len(text)
        start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        offset = np.arange(n) - start
        ahead = lambda k: start + (offset + k) % size
        key = text.astype(np.uint64)
        for k in (1, 2, 4):
            key = (key << np.uint64(8 * k)) | key[ahead(k)]
        reach = 8
        while True:
            order = np.argsort(key)  # ties are settled by the next round, or agree in all that matters
            if reach >= length:
                break
            ranked = key[order]
            rank = np.empty(n, np.uint64)
            rank[order[0]] = 0
            rank[order[1:]] = np.cumsum(ranked[1:] != ranked[:-1], dtype=np.uint64)
            bits = np.uint64(max(1, int(n).bit_length()))
            key = rank
            for step in (1, 2) if 3 * int(bits) <= 64 else (1,):
                key = (key << bits) | rank[ahead(step * reach)]
            reach *= 3 if 3 * int(bits) <= 64 else 2
        self.order = order
        # Two bytes before each suffix, cyclically.
        self.transform = ((text[ahead(-2)].astype(np.uint16) << np.uint16(8)) | text[ahead(-1)])[order]


def merge_transforms(shards: list[Shard], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order (numbers of suffixes in the concatenated shard orders) and where its blocks with ``length`` common bytes begin.

    ``source`` holds the shard of each merged suffix. One step reads the symbols in
    the order so far and distributes the suffixes before them stably by symbol.
    Two neighbours agree in two more bytes if their symbols and their old blocks do.
    """
    sizes = [len(s.order) for s in shards]
    total = sum(sizes)
    source = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)
    symbols = np.concatenate([s.transform for s in shards])
    block, next_block = np.zeros(total, np.int32), np.empty(total, np.int32)
    symbol = np.empty(total, np.uint16)
    new = np.zeros(total, bool)
    for _ in range(length // 2):
        symbol[np.argsort(source, kind="stable")] = symbols
        to = np.argsort(symbol, kind="stable")  # a radix sort
        source, sorted_symbol = source[to], symbol[to]
        np.take(block, to, out=next_block)
        np.not_equal(next_block[1:], next_block[:-1], out=new[1:])
        new[1:] |= sorted_symbol[1:] != sorted_symbol[:-1]
        np.cumsum(new, out=block)
    merged = np.empty(total, np.int64)
    merged[np.argsort(source, kind="stable")] = np.arange(total)
    return merged, np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))


def window_documents(segments: list[bytes], docs: np.ndarray, length: int = LENGTH, shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray]:
    """For all windows of all segments, one after the other, the smallest document among equal windows; and the windows per segment."""
    cuts = np.linspace(0, len(segments), min(shards, len(segments)) + 1).astype(int)
    built = [Shard(segments[a:b], length) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    merged, blocks = merge_transforms(built, length)
    sizes = np.array([len(s) for s in segments])
    starts = np.cumsum(sizes) - sizes
    bases = np.cumsum([0] + [len(s.order) for s in built[:-1]])
    suffix = np.concatenate([s.order + b for s, b in zip(built, bases, strict=True)])[merged]
    window = np.arange(sizes.sum()) - np.repeat(starts, sizes) <= np.repeat(sizes, sizes) - length
    value = np.where(window, np.repeat(docs, sizes), np.iinfo(np.int64).max)[suffix]
    least = np.minimum.reduceat(value, blocks)
    found = np.empty(len(suffix), np.int64)
    found[suffix] = np.repeat(least, np.diff(np.append(blocks, len(suffix))))
    return found[window], sizes - length + 1


def smallest_documents(segments: list[bytes], docs: np.ndarray, length: int = LENGTH, shards: int = SHARDS) -> list[np.ndarray]:
    """``window_documents`` by segment."""
    found, sizes = window_documents(segments, docs, length, shards)
    return np.split(found, np.cumsum(sizes)[:-1])


def earlier_runs(segments: list[bytes], docs: np.ndarray, length: int = LENGTH) -> dict[int, list[tuple[int, int]]]:
    """Runs of windows (first, end) that a smaller document than the segment's own has, by segment number."""
    found, sizes = window_documents(segments, docs, length)
    marked = found < np.repeat(docs, sizes)
    first = np.cumsum(sizes) - sizes
    before, after = np.concatenate([[False], marked[:-1]]), np.concatenate([marked[1:], [False]])
    before[first] = False
    after[first[1:] - 1] = False
    starts, ends = np.flatnonzero(marked & ~before), np.flatnonzero(marked & ~after) + 1
    owner = np.searchsorted(first, starts, side="right") - 1
    out: dict[int, list[tuple[int, int]]] = {}
    for i, s, e in zip(owner.tolist(), (starts - first[owner]).tolist(), (ends - first[owner]).tolist(), strict=True):
        out.setdefault(i, []).append((s, e))
    return out


# -- Spark ----------------------------------------------------------------

#: ``place`` is the bucket, shifted by 32 bits, and the number of its documents that have the anchor.
_COUNTS = pa.schema([("hash", pa.int64()), ("place", pa.int64())])
_WANTED = pa.schema([("bucket", pa.int32()), ("hash", pa.int64()), ("hot", pa.bool_())])
_SEGMENTS = pa.schema(
    [("route", pa.int64()), ("segment", pa.binary()), ("doc", pa.int64()), ("row", pa.binary()), ("bucket", pa.int32()), ("at", pa.list_(pa.int32()))]
)
_RANGES = pa.schema([("bucket", pa.int32()), ("row", pa.binary()), ("at", pa.list_(pa.int32()))])
_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
        ("row", pa.binary()),
    ]
)
_DDL = {
    "counts": "hash bigint, place bigint",
    "wanted": "bucket int, hash bigint, hot boolean",
    "segments": "route bigint, segment binary, doc bigint, row binary, bucket int, at array<int>",
    "ranges": "bucket int, row binary, at array<int>",
    "result": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, row binary",
}


def _bytes(column: pa.ChunkedArray) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _only_first(docs: pa.Table, copies: pa.Table) -> pa.Table:
    """``docs`` without the rows whose whole text a document with a smaller id has."""
    return docs.filter(pc.invert(pc.is_in(docs["row"], copies["row"].combine_chunks()))) if copies.num_rows else docs


def _count_anchors(length: int, k: int):
    def run(key: tuple, docs: pa.Table, copies: pa.Table) -> pa.Table:
        docs = _only_first(docs, copies)
        found = [(h, rows) for _, rows, _, _, h, _ in anchors(_bytes(docs["text"]), length, k)]
        if not found:
            return _COUNTS.empty_table()
        h, rows = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
        order = np.lexsort((rows, h))
        h, rows = h[order], rows[order]
        new_hash = np.concatenate([[True], h[1:] != h[:-1]])
        new_doc = new_hash | np.concatenate([[True], rows[1:] != rows[:-1]])
        at = np.flatnonzero(new_hash)
        n = np.add.reduceat(new_doc.astype(np.int32), at)
        return pa.table([h[at], np.int64(key[0].as_py() << 32) + n], schema=_COUNTS)

    return run


def _candidates(hot: int):
    """Of rows sorted by hash, those whose hash is in two or more documents."""

    def pick(h, place):
        n, bucket = place & 0xFFFFFFFF, (place >> 32).astype(np.int32)
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        sizes = np.diff(np.append(at, len(h)))
        total = np.repeat(np.add.reduceat(n, at), sizes)
        keep = total >= 2
        return pa.RecordBatch.from_arrays([pa.array(bucket[keep]), pa.array(h[keep]), pa.array(total[keep] > hot)], schema=_WANTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            now = [c.to_numpy() for c in b.columns]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            if not len(now[0]):
                continue
            cut = np.searchsorted(now[0], now[0][-1])  # the last hash may go on in the next batch
            if cut:
                yield pick(*(x[:cut] for x in now))
            rest = [x[cut:] for x in now]
        if rest is not None and len(rest[0]):
            yield pick(*rest)

    return run


def _cut_segments(length: int, k: int):
    def run(key: tuple, docs: pa.Table, wanted: pa.Table) -> pa.Table:
        whole = pc.is_null(wanted["hot"])  # rows of copies
        docs, wanted = _only_first(docs, wanted.filter(whole)), wanted.filter(pc.invert(whole))
        if not docs.num_rows or not wanted.num_rows:
            return _SEGMENTS.empty_table()
        bucket = docs["bucket"][0].as_py()
        hashes, hot = wanted["hash"].to_numpy(), wanted["hot"].to_numpy(zero_copy_only=False)
        order = np.argsort(hashes)
        hashes, hot = hashes[order], hot[order]
        docs = docs.sort_by([("doc_id", "ascending")])
        ids, keys = docs["doc_id"].to_pylist(), docs["row"].to_pylist()
        #: Segment -> smallest document, route, and its places by row.
        first: dict[bytes, tuple[int, int, dict[int, list[int]]]] = {}
        covered: dict[int, list[int]] = {}
        for data, rows, lo, hi, h, offsets in anchors(_bytes(docs["text"]), length, k):
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = np.flatnonzero(hashes[at] == h)
            raw = data.tobytes()
            split = hit[hot[at[hit]]]
            hit = hit[~hot[at[hit]]]
            if len(split):
                sizes = hi[split] - lo[split] + 1
                starts = np.repeat(lo[split], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                single = zip(np.repeat(rows[split], sizes).tolist(), starts.tolist(), starts.tolist(), _hash_at(data, starts, length).tolist(), np.repeat(offsets[split], sizes).tolist(), strict=True)
            else:
                single = ()
            entire = zip(rows[hit].tolist(), lo[hit].tolist(), hi[hit].tolist(), h[hit].tolist(), offsets[hit].tolist(), strict=True)
            for part in (entire, single):
                for r, a, b, route, offset in part:
                    segment, doc, row = raw[a : b + length], ids[r], keys[r]
                    known = first.get(segment)
                    if known is None:
                        first[segment] = (doc, route, {row: [a + offset]})
                    elif known[0] == doc:
                        known[2].setdefault(row, []).append(a + offset)
                    else:  # texts come by id: a smaller document has it
                        covered.setdefault(row, []).extend((a + offset, b + length + offset))
        out = [(route, s, doc, row, bucket, at) for s, (doc, route, places) in first.items() for row, at in places.items()]
        out += [(int.from_bytes(row[:8], "little", signed=True), None, None, row, bucket, _joined(at)) for row, at in covered.items()]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SEGMENTS, strict=True)], schema=_SEGMENTS) if out else _SEGMENTS.empty_table()

    return run


def _joined(flat: list[int]) -> list[int]:
    """Ranges (start, end, start, end...) as sorted ranges that do not touch."""
    out: list[int] = []
    for a, b in sorted(zip(flat[::2], flat[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _covered_ranges(rows: list[tuple], length: int) -> list[tuple]:
    """Ranges of whole groups of rows ``(route, segment, doc, row, bucket, at)``; a segment stands under one route only."""
    number: dict[bytes, int] = {}
    least: list[int] = []
    routes: list[int] = []
    of: dict[int, int] = {}
    for route, segment, doc, _, _, _ in rows:
        i = number.setdefault(segment, len(least))
        if i == len(least):
            least.append(doc)
            routes.append(route)
            of[route] = of.get(route, 0) + 1
        elif doc < least[i]:
            least[i] = doc
    # Where all of an anchor's segments are equal there is nothing to merge.
    several = [(s, i) for s, i in number.items() if of[routes[i]] > 1]
    runs: dict[int, list[tuple[int, int]]] = {}
    if several:
        found = earlier_runs([s for s, _ in several], np.array([least[i] for _, i in several], np.int64), length)
        runs = {several[k][1]: r for k, r in found.items()}
    out = []
    for _, segment, doc, row, bucket, at in rows:
        i = number[segment]
        if least[i] < doc:
            out.append((bucket, row, [x for a in at for x in (a, a + len(segment))]))
        elif i in runs:
            out.append((bucket, row, [x for a in at for s, e in runs[i] for x in (a + s, a + e - 1 + length)]))
    return out


def _merge_segments(length: int, merge_bytes: int):
    def batch(found):
        cols = list(zip(*found, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _RANGES, strict=True)], schema=_RANGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for b in batches:
            done = []
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[1] is None:
                    done.append((r[4], r[3], r[5]))
                    continue
                if size >= merge_bytes and r[0] != held[-1][0]:
                    done += _covered_ranges(held, length)
                    held, size = [], 0
                held.append(r)
                size += len(r[1])
            if done:
                yield batch(done)
        if held:
            yield batch(_covered_ranges(held, length))

    return run


def _remove(key: tuple, docs: pa.Table, ranges: pa.Table) -> pa.Table:
    covered: dict[int, list[int]] = {}
    copies = set()
    for row, at in zip(ranges["row"].to_pylist(), ranges["at"].to_pylist(), strict=True):
        if at is None:
            copies.add(row)
        else:
            covered.setdefault(row, []).extend(at)
    out = []
    for doc, row, text in zip(docs["doc_id"].to_pylist(), docs["row"].to_pylist(), _bytes(docs["text"]), strict=True):
        gone = [0, len(text)] if row in copies else _joined(covered.get(row, []))
        kept, at = [], 0
        for s, e in zip(gone[::2], gone[1::2], strict=True):
            kept.append(text[at:s])
            at = e
        kept = b"".join([*kept, text[at:]])
        out.append((doc, len(text), len(text) - len(kept), len(gone) // 2, hashlib.sha256(kept).hexdigest(), row))
    cols = list(zip(*out, strict=True)) or [[] for _ in _RESULT]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _RESULT, strict=True)], schema=_RESULT)


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    k: int = K,
    bucket_bytes: int = BUCKET_BYTES,
    hot: int = HOT,
    merge_bytes: int = MERGE_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row."""
    if length % 2 or not 1 <= k <= length:
        raise ValueError("the length must be even and an anchor no longer than it")
    spark = docs.sparkSession
    prepare_workers(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    # A row is known by its id and text: rows that repeat both have the same result.
    digest = F.sha2("text", 256)
    row = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest), 256)
    own = own.withColumn("row", F.unhex(F.substring(row, 1, 32)))
    size = F.octet_length("text")
    names = stored(own.select("doc_id", "row", size.alias("size"), F.unhex(digest).alias("digest")), "repeat-names")
    total, rows, distinct = names.agg(F.sum("size"), F.count("*"), F.count_distinct("row")).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    bucket = F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int").alias("bucket")
    every = names.select("row")
    if distinct < rows:
        # One of the rows that repeat id and text; folded per task, so that very many never meet.
        own = own.groupBy("row").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("text").alias("text"))
    own = own.select("doc_id", "text", "row", bucket)
    named = own.where("doc_id IS NOT NULL").where(size >= length)

    # Whole texts that a smaller document has lose every byte and need no search.
    names = names.where("doc_id IS NOT NULL").where(F.col("size") >= length)
    firsts = names.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = stored(names.join(firsts, "digest").where("doc_id > first").select(bucket, "row").distinct(), "repeat-copies")
    copies = copies.select("bucket", F.lit(None).cast("bigint").alias("hash"), F.lit(None).cast("boolean").alias("hot"), "row")

    counts = named.groupBy("bucket").cogroup(copies.groupBy("bucket")).applyInArrow(_count_anchors(length, k), _DDL["counts"])
    wanted = stored(counts.repartition("hash").sortWithinPartitions("hash").mapInArrow(_candidates(hot), _DDL["wanted"]), "repeat-anchors")
    wanted = wanted.select("*", F.lit(None).cast("binary").alias("row"))
    segments = named.groupBy("bucket").cogroup(wanted.union(copies).groupBy("bucket")).applyInArrow(_cut_segments(length, k), _DDL["segments"])
    ranges = segments.repartition("route").sortWithinPartitions("route").mapInArrow(_merge_segments(length, merge_bytes), _DDL["ranges"])
    ranges = stored(ranges, "repeat-ranges").union(copies.select("bucket", "row", F.lit(None).cast("array<int>")))
    result = own.groupBy("bucket").cogroup(ranges.groupBy("bucket")).applyInArrow(_remove, _DDL["result"])
    return (result if distinct == rows else every.join(result, "row")).drop("row")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
