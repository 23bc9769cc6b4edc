"""Near-duplicate embeddings by spherical-cap filters.

A rotated unit vector is cut into two halves, each with its own random code. A
pair of code words is one filter direction; the vector belongs to all filters
whose direction it exceeds a threshold with. They are listed from the halves'
inner products without trying every pair: a word of one half counts only if the
best word of the other half can still lift the sum over the threshold. Vectors
that share a filter are compared in double precision; a pair counts only in the
first filter that both have.

The number of directions and the threshold follow from the largest label's size,
so that a vector is in about ``FILTERS`` filters and a filter of unrelated vectors
holds about ``BUCKET`` of them at every size. Equal vectors are one class, with a
number of its own, from the start.

A filter with many more members holds a large group of near copies. Vectors within
half the threshold's angle of one of them are near each other without a look: such a
*core* is counted by its size and joined through its representative. Only the members
outside a filter's largest core are compared, in blocks that meet blocks of all
members, so the rows moved grow with the members and with the outside ones, not with
the square of the group.

Vectors that are null, empty, zero or hold a null or non-finite component, and
those without a label, link with nothing; so do vectors of different lengths.
Rows that repeat an id with one label are one vector if they are equal; an id on
several vectors or labels is a vector in each, with links and a component of its own.
A row with a null id links with nothing, has a null component and is kept. A cosine of exactly the threshold
links. An empty table gives no rows; only the named columns are read. The recall for pairs at
the threshold is about 0.999 (tests hold it against brute force).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns, prepare_workers, stored, table
from .components import COMPONENT_SQL, connected_components

COSINE = 0.98
#: Filters that a vector is in, on average.
FILTERS = 24
#: Independent rotations and codes that these come from.
CODES = 8
#: Unrelated vectors of the largest label that share a filter, on average.
BUCKET = 32
#: Most members of a filter that are compared at once.
BLOCK = 512
SEED = 11


@lru_cache(maxsize=64)
def code(dim: int, words: int, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A seeded rotation and the unit code words of both halves."""
    rng = np.random.RandomState(SEED + 1000 * number + dim)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    halves = []
    for size in (dim - dim // 2, dim // 2):
        c = rng.standard_normal((words, size))
        halves.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300) if size else c)
    return rotation, *halves


def sizing(largest: int) -> tuple[int, float]:
    """Code words per half, and the share of unrelated vectors that a filter holds."""
    share = min(0.02, BUCKET / max(1, largest))
    return int(np.ceil(np.sqrt(FILTERS / CODES / share))), share


@lru_cache(maxsize=64)
def cap(dim: int, share: float) -> float:
    """The inner product that a random unit vector exceeds with probability ``share``."""
    angle = np.linspace(0, np.pi, 200_001)
    mass = np.cumsum(np.sin(angle) ** max(0, dim - 2))
    return float(np.cos(angle[np.searchsorted(mass, share * mass[-1])]))


def listed(x: np.ndarray, words: int, share: float) -> list[np.ndarray]:
    """For each unit row the sorted numbers of its filters; the best one of each code is always among them."""
    n, dim = x.shape
    out_row, out = [], []
    for number in range(CODES):
        rotation, first, second = code(dim, words, number)
        y = x @ rotation
        a, b = y[:, : first.shape[1]] @ first.T, y[:, first.shape[1] :] @ second.T
        # A direction is a pair of unit words over the square root of 2.
        least = np.minimum(cap(dim, share) * np.sqrt(2), a.max(axis=1) + b.max(axis=1))
        row, i = np.nonzero(a >= (least - b.max(axis=1))[:, None])
        for at in range(0, len(row), 8192):
            r, k = row[at : at + 8192], i[at : at + 8192]
            hit, j = np.nonzero(b[r] >= (least[r] - a[r, k])[:, None])
            out_row.append(r[hit])
            out.append((number * words + k[hit].astype(np.int64)) * words + j)
    rows, found = np.concatenate(out_row), np.concatenate(out)
    order = np.lexsort((found, rows))
    return np.split(found[order], np.cumsum(np.bincount(rows, minlength=n))[:-1])


def parsed(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v, key``: usable vectors as bytes with a digest, null otherwise."""
    element = vectors.schema[vector_col].dataType.elementType
    kind = np.float32 if isinstance(element, T.FloatType) else np.float64

    def make():
        def call(ids, labels, rows):
            v: list[bytes | None] = []
            for i, label, x in zip(ids, labels, rows, strict=True):
                a = None if i is None or label is None or not x or None in x else np.array(x, kind)
                usable = a is not None and np.isfinite(a).all() and a.any()
                v.append((a + 0).tobytes() if usable else None)  # + 0: minus zero is zero
            return [ids, labels, v, [None if b is None else hashlib.blake2b(b, digest_size=16).digest() for b in v]]

        return call

    own = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    return map_columns(own, make, f"vec_id {vectors.schema[id_col].dataType.simpleString()}, label string, v binary, key binary", 1024)


def _doubles(rows: list[bytes], size: int) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), np.float32 if size == 4 else np.float64).reshape(len(rows), -1).astype(np.float64)
    return x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norms


#: What a row does in its group: is compared with those that ask, asks, or both (in a group of one block).
ASKED, ASKS, BOTH = 0, 1, 2


def compare(ids, mult, rows, filters, role, core, outside, number: int, cosine: float, size: int) -> list[tuple]:
    """Links of one filter (or pair of its blocks): ``(id, links, smallest id of its local component)``.

    Pairs within one core are left out, they are known.
    """
    v = _doubles(rows, size)
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    near = v @ v.T >= cosine * norm[:, None] * norm[None, :]
    near &= (core[:, None] != core) | (core < 0)
    if (role == BOTH).all():
        np.fill_diagonal(near, False)
    else:  # two outside members once, and none with itself
        near &= (role == ASKS)[:, None] & (role == ASKED) & ((outside & (ids[:, None] < ids)) | ~outside)
        near |= near.T
    if not near.any():
        return []
    some = np.flatnonzero(near.any(axis=1))
    near = near[np.ix_(some, some)]
    # A pair with an earlier common filter has been counted there.
    earlier = [f[f < number] for f in (filters[k] for k in some)]
    names, at = np.unique(np.concatenate(earlier), return_inverse=True)
    has = np.zeros((len(some), len(names)), np.float32)
    has[np.repeat(np.arange(len(some)), [len(f) for f in earlier]), at] = 1
    near &= has @ has.T == 0
    if not near.any():
        return []
    ids, mult = ids[some], mult[some]
    links = near @ mult
    root = ids.copy()
    while True:
        best = np.minimum(root, np.where(near, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (best == root).all():
            break
        root = best
    return [(int(i), int(n), int(r)) for i, n, r in zip(ids, links, root, strict=True) if n]


_LINKS = "id bigint, links bigint, root bigint"


def _compare_groups(cosine: float, size: int):
    """Walks sorted groups of ``label, dim, filter, lo, hi``; a group is at most two blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def done():
            if len(rows) < 2:
                return []
            ids, mult, v, filters, role, core, outside = zip(*rows, strict=True)
            same = [np.array(x) for x in (role, core, outside)]
            return compare(np.array(ids), np.array(mult), list(v), [np.array(f) for f in filters], *same, group[2], cosine, size)

        def batch(found):
            cols = list(zip(*found, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "links", "root"])

        found = []
        for b in batches:
            c = [x.to_pylist() for x in b.columns]
            for k in range(b.num_rows):
                key = (c[0][k], c[1][k], c[2][k], c[3][k], c[4][k])
                if key != group:
                    found += done()
                    group, rows = key, []
                rows.append(tuple(c[i][k] for i in range(5, 12)))
            if len(found) > 10_000:
                yield batch(found)
                found = []
        yield batch(found + done())

    return run


def cores(members: DataFrame, cosine: float, size: int) -> DataFrame:
    """``id, core`` of the vectors that are so near a representative of their filter that all of them are linked.

    ``members`` are the rows ``label, dim, filter, blocks, side, id, v`` of large filters; a
    filter's representative is its member with the smallest id.
    """
    # cos(2 t) = 2 cos(t)**2 - 1; the margin is far above the rounding of doubles.
    least = np.sqrt((1 + cosine) / 2) + 1e-5
    group = ["label", "dim", "filter"]
    first = members.groupBy(*group).agg(F.min(F.struct("id", "v")).alias("r"), F.any_value("blocks").alias("blocks"))
    # The representative goes to every block, so that no task gets a whole filter.
    first = first.select(*group, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("side"), F.col("r.id").alias("core"), F.col("r.v").alias("rv"))

    def make():
        def call(ids, core, v, rv):
            near = [False] * len(ids)
            dims = np.array([len(x) for x in v])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x, y = _doubles([v[k] for k in at], size), _doubles([rv[k] for k in at], size)
                x, y = (z / np.linalg.norm(z, axis=1, keepdims=True) for z in (x, y))
                for k, c in zip(at, np.einsum("ij,ij->i", x, y), strict=True):
                    near[k] = bool(c >= least)
            return [ids, core, near]

        return call

    both = members.select(*group, "side", "id", "v").join(first, [*group, "side"]).select("id", "core", "v", "rv")
    found = map_columns(both, make, "id bigint, core bigint, near boolean", 1024).where("near")
    return found.groupBy("id").agg(F.min("core").alias("core"))


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row; ids must be integers."""
    size = 4 if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else 8
    rows = stored(parsed(vectors, id_col, vector_col, label_col), "vectors")
    classes = stored(
        rows.where("key IS NOT NULL")
        .groupBy("label", "key")
        .agg(F.min("vec_id").cast("bigint").alias("vec"), F.any_value("v").alias("v"), F.count_distinct("vec_id").alias("mult"))
        .withColumn("id", F.monotonically_increasing_id()),
        "vector-classes",
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    words, share = sizing(largest)

    def make():
        def call(labels, ids, mult, v):
            filters: list = [None] * len(ids)
            dims = np.array([len(x) // size for x in v])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = _doubles([v[k] for k in at], size)
                for k, f in zip(at, listed(x / np.linalg.norm(x, axis=1, keepdims=True), words, share), strict=True):
                    filters[k] = f
            return [labels, dims, ids, mult, v, filters]

        return call

    schema = "label string, dim int, id bigint, mult bigint, v binary, filters array<bigint>"
    placed = stored(map_columns(classes.select("label", "id", "mult", "v"), make, schema, 256), "vector-filters")
    group = ["label", "dim", "filter"]
    each = placed.select("label", "dim", F.explode("filters").alias("filter"), "id", "mult", "v", "filters")
    counts = placed.select("label", "dim", F.explode("filters").alias("filter")).groupBy(*group).count().where("count > 1")
    counts = stored(counts.select(*group, F.ceil(F.col("count") / block).cast("int").alias("blocks")), "vector-buckets")
    row = [*group, "lo", "hi", "id", "mult", "v", "filters", "role", "core", "outside"]
    core = None
    if not counts.where("blocks > 1").isEmpty():
        side = lambda blocks, salt: F.pmod(F.xxhash64("id", F.lit(salt)), blocks).cast("int")
        large = stored(each.drop("filters").join(counts.where("blocks > 1"), group).withColumn("side", side("blocks", 1)), "vector-large")
        core = stored(cores(large, cosine, size), "vector-cores")
        placed = stored(placed.join(core, "id", "left").withColumn("core", F.coalesce("core", F.lit(-1))), "vector-filters")
        known = large.select(*group, "id", "blocks").join(placed.select("id", "core"), "id")
        inner = known.where("core >= 0").groupBy(*group, "core").count().groupBy(*group).agg(F.max_by("core", F.struct("count", "core")).alias("inner"))
        known = stored(known.join(inner, group, "left").withColumn("outside", ~F.col("core").eqNullSafe(F.col("inner"))).drop("inner"), "vector-known")
        outer = known.where("outside").groupBy(*group).agg(F.ceil(F.count("*") / block).cast("int").alias("outer_blocks"))
        known = known.join(outer, group).join(placed.select("id", "mult", "v", "filters"), "id")
        to = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
        asks = known.where("outside").withColumn("lo", side("outer_blocks", 2)).withColumn("hi", to("blocks")).withColumn("role", F.lit(ASKS))
        asked = known.withColumn("hi", side("blocks", 1)).withColumn("lo", to("outer_blocks")).withColumn("role", F.lit(ASKED))
        more = asks.select(*row).union(asked.select(*row))
    else:
        placed = placed.withColumn("core", F.lit(-1).cast("bigint"))
    # Within small filters too, pairs of one core are known.
    each = placed.select("label", "dim", F.explode("filters").alias("filter"), "id", "mult", "v", "filters", "core")
    fixed = {"lo": 0, "hi": 0, "role": BOTH, "outside": True}
    parts = each.join(counts.where("blocks = 1"), group).withColumns({k: F.lit(v) for k, v in fixed.items()}).select(*row)
    if core is not None:
        parts = parts.union(more)
    keys = [*group, "lo", "hi"]
    prepare_workers(vectors.sparkSession)
    links = parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compare_groups(cosine, size), _LINKS)
    if core is not None:
        # The links inside cores, by size.
        own = core.join(classes.select("id", "mult"), "id")
        total = own.groupBy("core").agg(F.sum("mult").alias("total"))
        links = links.union(own.join(total, "core").select("id", F.col("total") - F.col("mult"), "core"))
    links = stored(links, "vector-links")

    found = connected_components(links.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")), "vector-components")
    own = classes.select("label", "key", "id", "vec", "mult").join(found, "id", "left").withColumn("number", F.coalesce("component", "id"))
    least = own.groupBy("number").agg(F.min("vec").alias("least"))
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    linked = own.join(least, "number").join(counted, "id", "left").select(
        "label", "key", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n"), F.col("least").alias("component")
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return rows.select("vec_id", "label", "key").join(linked, ["label", "key"], "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP7_SQL = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
    AND list_bool_or([x <> 0 FOR x IN embedding])),
link AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= {COSINE}),
node AS (SELECT vec_id AS id FROM embeddings),{COMPONENT_SQL},
degree AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, least AS component_id, id = least AS kept
FROM component LEFT JOIN degree ON a = id
"""
