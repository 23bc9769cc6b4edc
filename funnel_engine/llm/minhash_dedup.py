"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

Each document's distinct word shingles give ``BANDS * ROWS`` minima. Bands of
minima propose candidates; of every minimum the low ``BITS`` bits are kept, packed
into 64-bit words, and the equal lanes of two signatures, counted by bit counts
and corrected for chance collisions, estimate the similarity. Pairs whose
estimate is clearly below the threshold go no further; the others are confirmed
on the full sets.

Documents with equal sets are one class with a number of its own, so copies make
no pairs, and an id on several texts is in several classes; components get their
smallest document id at the end. Members of a band's bucket are first compared with the
bucket's smallest class only. Where that leaves members of one bucket in
different components, those outside the smallest one's component are compared with
all members of other components, so no link between different sets is lost to
the shortcut, and a large group of copies never compares all its pairs. That
second comparison runs in numpy: blocks of outside members meet blocks of all
members, which carry their sets, so the rows moved grow with the members and with the
outside ones, not with the square of the bucket; only links that join two components
leave a block.

A band misses a pair at similarity ``s`` with probability ``1 - s**ROWS``; all 25
bands of 5 miss one at 0.85 with probability 7e-7, one at 0.8 with 5e-5.

Ids must be integers. Null and empty texts have no shingles, link with nothing and are kept; a row
without an id links with nothing, keeps a null component and is kept. Rows that
repeat an id with one text stay or go together; those with other texts are judged by themselves.
A similarity of exactly the threshold links. Very long texts are shingled whole; an empty table
gives no rows. Other columns are passed on by ``drop_near_duplicates`` and never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, map_columns, prepare_workers, stored, table, texts, whole_row
from .components import COMPONENT_SQL, connected_components

WORDS = 5
PERCENT = 80
BANDS, ROWS, BITS = 25, 5, 2
LANES = 64 // BITS
#: Words of 64 bits in a signature: 128 lanes, of which the bands use 125.
PACKED = 4
PERMUTATIONS = PACKED * LANES
#: Pairs go on to the full sets unless their estimate is lower than the threshold by so much
#: (about five standard deviations of the estimate).
SLACK = 0.17
#: Members of a bucket that are compared at once; larger buckets are cut into blocks.
BLOCK = 512
#: Shingles of a block's members together, on average (8 bytes each).
BLOCK_SHINGLES = 2_000_000
#: Distinct word hashes kept per worker.
CACHE = 200_000

_rng = np.random.RandomState(20240229)
_A = (_rng.randint(0, 1 << 31, PERMUTATIONS).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.randint(0, 1 << 31, PERMUTATIONS).astype(np.uint32) * np.uint32(2) + _rng.randint(0, 2, PERMUTATIONS).astype(np.uint32)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingler(n: int) -> Callable[[str], np.ndarray]:
    """Sorted distinct 64-bit hashes of a text's shingles of ``n`` words (A-Z lower-cased); fewer words are one shingle."""
    known = _Hashes()

    def shingles(text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(known) > CACHE:
            known.clear()
        x = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(x) < n:
            # Not a shingle's length: the count of words enters, so that no longer text gives the same value.
            h = np.full(1, len(x), np.uint64)
            for k in range(len(x)):
                h = _spread(h * _STEP + x[k])
            return h
        h = np.zeros(len(x) - n + 1, np.uint64)
        for k in range(n):
            h = _spread(h * _STEP + x[k : len(x) - n + 1 + k])
        return np.unique(h)

    return shingles


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each permutation over a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        out = np.minimum(out, (_A[:, None] * x[None, at : at + 4096] + _B[:, None]).min(axis=1))
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per band and row of minima; keys of different bands differ."""
    x = least[:, : BANDS * ROWS].reshape(len(least), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), x.shape[:2]).copy()
    for k in range(ROWS):
        h = _spread(h * _STEP + x[:, :, k])
    return h.view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of each minimum (after mixing), ``LANES`` to a 64-bit word."""
    x = _spread(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    x = x.reshape(len(least), PACKED, LANES) << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(x, axis=2).view(np.int64)


def signatures(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, digest, bands, packed, text_digest``; without shingles the three in the middle are null."""

    def make():
        shingles = shingler(words)

        def call(ids, bodies):
            sets = [shingles(t) for t in bodies]
            some = [i for i, s in enumerate(sets) if len(s)]
            digest, bands, low = ([None] * len(ids) for _ in range(3))
            if some:
                least = np.stack([minima(sets[i]) for i in some])
                for i, b, p in zip(some, band_keys(least), packed(least), strict=True):
                    digest[i], bands[i], low[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), b, p
            return [ids, [len(s) for s in sets], digest, bands, low, [hashlib.sha256(t.encode()).digest() for t in bodies]]

        return call

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles bigint, digest binary, bands array<bigint>, packed array<bigint>, text_digest binary"
    return map_columns(texts(docs, id_col, text_col), make, schema)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from the equal lanes of two packed signatures, corrected for chance collisions."""
    odd = F.lit(int("01" * LANES, 2))
    differing = F.lit(0)
    for k in range(PACKED):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        differing = differing + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(odd))
    same = 1 - differing / F.lit(float(PERMUTATIONS))
    chance = 1 / (1 << BITS)
    return (same - chance) / (1 - chance)


def _near(a: str, b: str, percent: int) -> Column:
    """Whether sizes and signatures allow the similarity."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent
    return sizes & (estimate(F.col(f"{a}.packed"), F.col(f"{b}.packed")) >= percent / 100 - SLACK)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("n"), (F.size("x") + F.size("y")).alias("total"))
    return joined.where(F.col("n") * 100 >= (F.col("total") - F.col("n")) * percent).select("a", "b")


def _similar(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which signatures of ``a`` (rows) and ``b`` (columns) have at least the estimate; the same as ``estimate``."""
    odd = np.uint64(int("01" * LANES, 2))
    differing = np.zeros((len(a), len(b)), np.int32)
    for k in range(PACKED):
        x = a[:, k, None] ^ b[None, :, k]
        differing += np.bitwise_count((x | (x >> np.uint64(1))) & odd)
    chance = 1 / (1 << BITS)
    return (1 - differing / PERMUTATIONS - chance) / (1 - chance) >= least


def bucket_links(key: int, rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links that join different components among rows ``(asks, id, component, outside, bands, packed, shingles)`` of one bucket.

    Rows that ask are compared with those that do not, two outside members once. A
    pair is left to the first band that both share, and of the links found only those
    are returned that join components not joined yet.
    """
    asks, ids, comp, outside = (np.array(x) for x in list(zip(*rows, strict=True))[:4])
    asks = asks.astype(bool)
    if asks.all() or not asks.any():
        return []
    bands = np.array([r[4] for r in rows])
    low = np.array([r[5] for r in rows]).view(np.uint64)
    sets = [np.array(r[6], np.int64) for r in rows]
    n = np.array([len(x) for x in sets])
    band = int(np.flatnonzero(bands[0] == key)[0])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(n) - n
    parent = {int(c): int(c) for c in comp}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    mark = np.zeros(flat.max() + 1, np.int32)
    asking = np.flatnonzero(asks)
    for at in range(0, len(asking), 64):
        part = asking[at : at + 64]
        near = _similar(low[part], low, percent / 100 - SLACK)
        near &= np.minimum(n[part, None], n) * 100 >= np.maximum(n[part, None], n) * percent
        near &= (comp[part, None] != comp) & ~asks
        near &= ~outside | (ids[part, None] < ids)  # two outside members once
        for i, row in zip(part[near.any(axis=1)], near[near.any(axis=1)], strict=True):
            j = np.flatnonzero(row)
            j = j[~(bands[j, :band] == bands[i, :band]).any(axis=1)]
            if not len(j):
                continue
            own = flat[starts[i] : starts[i] + n[i]]
            mark[own] = 1
            both = np.add.reduceat(mark[flat], starts)[j] if len(j) > 8 else np.array([mark[flat[starts[k] : starts[k] + n[k]]].sum() for k in j])
            mark[own] = 0
            for k in j[both * 100 >= (n[i] + n[j] - both) * percent]:
                x, y = find(int(comp[i])), find(int(comp[k]))
                if x != y:
                    parent[x] = y
                    links.append((int(ids[i]), int(ids[k])))
    return links


def _compare_buckets(percent: int):
    """Walks rows sorted by bucket and pair of blocks."""

    def batch(links):
        a, b = zip(*links, strict=True) if links else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for b in batches:
            for part in (b.slice(at, 256) for at in range(0, b.num_rows, 256)):
                for r in zip(*(c.to_pylist() for c in part.columns[:9]), (x.values.to_numpy() for x in part.columns[9]), strict=True):
                    if r[:3] != group:
                        if len(rows) > 1:
                            yield batch(bucket_links(group[0], rows, percent))
                        group, rows = r[:3], []
                    rows.append(r[3:])
        if len(rows) > 1:
            yield batch(bucket_links(group[0], rows, percent))

    return run


def shingle_sets(docs: DataFrame, classes: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """``id, shingles`` of the classes in ``classes(id, digest, doc_id)``, from the texts of ``doc_id`` that have the digest."""

    def make():
        shingles = shingler(words)

        def call(bodies):
            sets = [shingles(t) for t in bodies]
            return [[hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets], [x.view(np.int64) for x in sets]]

        return call

    own = texts(docs, id_col, text_col).join(classes.select("doc_id"), "doc_id", "left_semi").select("text")
    sets = map_columns(own, make, "digest binary, shingles array<bigint>", 128).dropDuplicates(["digest"])
    return sets.join(classes.select("id", "digest"), "digest").select("id", "shingles")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row; links join sets with ``100 * intersection >= percent * union``."""
    return _judged(docs, words, percent, id_col, text_col, block).drop("text_digest")


def _judged(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str, block: int = BLOCK) -> DataFrame:
    """``near_duplicates`` and the SHA-256 of the text."""
    signed = stored(signatures(docs, words, id_col, text_col), "minhash-signatures")
    classes = stored(
        signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"), F.any_value("packed").alias("packed"))
        .withColumn("id", F.monotonically_increasing_id()),
        "minhash-classes",
    )
    keys = classes.select("id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("members"), F.min("id").alias("first")).where("members > 1").select("key", "first")
    members = stored(keys.join(shared, "key"), "minhash-buckets")
    own = classes.select("id", "n", "packed")

    def sides(pairs: DataFrame) -> DataFrame:
        a = own.select(F.col("id").alias("a"), F.struct("n", "packed").alias("l"))
        b = own.select(F.col("id").alias("b"), F.struct("n", "packed").alias("r"))
        return pairs.join(a, "a").join(b, "b").where(_near("l", "r", percent)).select("a", "b")

    # Round 1: each member with the first of its bucket.
    pairs = stored(sides(members.where("id != first").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct()), "minhash-pairs")
    named = classes.select("id", "digest", "doc_id").join(members.select("id").distinct(), "id", "left_semi")
    sets = stored(shingle_sets(docs, named, words, id_col, text_col), "minhash-sets")
    links = stored(_confirmed(pairs, sets, percent), "minhash-links")
    found = stored(connected_components(links, "minhash-round1"), "minhash-round1")

    # Round 2: members outside the component of their bucket's first with all members of other components.
    placed = members.join(found, "id", "left").select("id", "key", "first", F.coalesce("component", "id").alias("c"))
    firsts = found.select(F.col("id").alias("first"), F.col("component").alias("fc"))
    placed = placed.join(firsts, "first", "left").select("id", "key", "c", (F.col("c") != F.coalesce("fc", "first")).alias("outside"))
    # Blocks of outside members meet blocks of all members, so copies grow with the outside members, not with the bucket's square.
    # A block holds so many members, and fewer where sets are long.
    placed = placed.join(classes.select("id", "n"), "id")
    of_block = lambda members, shingles: F.greatest(F.ceil(members / block), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
    outer = F.col("outside")
    mixed = placed.groupBy("key").agg(
        of_block(F.count("*"), F.sum("n")).alias("blocks"),
        of_block(F.count_if(outer), F.sum(F.when(outer, F.col("n")))).alias("outer_blocks"),
        F.max("outside").alias("mixed"),
    )
    placed = stored(placed.join(mixed.where("mixed").drop("mixed"), "key"), "minhash-mixed")
    side = lambda blocks, salt: F.pmod(F.xxhash64("id", F.lit(salt)), blocks).cast("int")
    to = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    row = ["key", "id", "c", "outside"]
    asking = placed.where("outside").select(*row, side("outer_blocks", 1).alias("lo"), to("blocks").alias("hi"), F.lit(True).alias("asks"))
    asked = placed.select(*row, side("blocks", 2).alias("hi"), to("outer_blocks").alias("lo"), F.lit(False).alias("asks"))
    # Sets travel with the rows, so that pairs are confirmed where they meet and none is written out.
    wide = asking.unionByName(asked).join(classes.select("id", "bands", "packed"), "id").join(sets, "id")
    wide = wide.select("key", "lo", "hi", "asks", F.col("id").cast("bigint").alias("id"), F.col("c").cast("bigint").alias("c"), "outside", "bands", "packed", "shingles")
    prepare_workers(docs.sparkSession)
    wide = wide.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    more = wide.mapInArrow(_compare_buckets(percent), "a bigint, b bigint")
    links = more.union(found.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b")))
    found = connected_components(links, "minhash-round2")

    own = classes.select("digest", "id", "doc_id").join(found, "id", "left").withColumn("number", F.coalesce("component", "id"))
    own = stored(own.select("digest", "number", "doc_id"), "minhash-placed")
    least = own.groupBy("number").agg(F.min("doc_id").alias("component"))
    own = own.select("digest", "number").join(least, "number").select("digest", "component")
    rows = signed.select("doc_id", "n_shingles", "digest", "text_digest").join(own, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        "text_digest",
    )


def drop_near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all their columns, of the document with the smallest id of each group."""
    gone = _judged(docs, words, percent, id_col, text_col).where("NOT kept").select("doc_id", "text_digest").distinct()
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    own = docs.select(F.col(id_col).alias("doc_id"), digest.alias("text_digest"), whole_row(docs).alias("row"))
    return own.join(stored(gone, "minhash-gone"), ["doc_id", "text_digest"], "left_anti").select("row.*")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


OP10_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) AS ws FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS s FROM d, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1)) AS u(i)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
node AS (SELECT doc_id AS id FROM d),{COMPONENT_SQL}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least AS component_id, d.doc_id = least AS kept
FROM d JOIN component ON id = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id
"""
