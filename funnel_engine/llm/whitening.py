"""Whitening of embeddings on exact principal components.

Entries become integers, ``floor(256 c)``, so the scatter of the distinct vectors is an
integer matrix, gathered exactly by Spark. Its eigenvalues come from its characteristic
polynomial, which is computed without rounding: Spark tasks reduce the matrix to
Hessenberg form modulo primes and the coefficients are put together by the Chinese
remainder theorem, from as many primes as their bound asks for. All roots are real, so
the sign changes of the polynomial shifted by ``a`` count the roots above ``a`` exactly;
bisection isolates the largest ones to ``BITS`` binary digits. Components span the null
space of scatter minus root, by inverse iteration in decimals of ``DIGITS`` digits.

With n vectors x of sum S, the centred entries n x - S are integers too. Their products
add up to n (n sum(x x') - S S'), term by term equal to n times the matrix used here, so
gathering sum(x x') loses nothing to gathering centred products.

The driver sees sums per pair of dimensions, residues and components, whose number
depends on the dimensions alone; vectors stay in tasks, of any number of rows.

Rows whose vector is null or holds null or non-finite entries are dropped, and so are
vectors whose length is not the usual one (the most frequent among distinct vectors;
ties: the longest). Entries beyond a long become its limits. Repeated rows and null ids
come back as they are; in the fit each distinct vector counts once. Components of equal
eigenvalues are some orthonormal base. A component with eigenvalue 0 has no whitened
value (null) and explains 0; where all have, ``explained`` and the identity's error are
null. A deviation beyond a long is null. An empty table, or one without usable vectors,
gives no rows. Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare_workers, stored, table

#: Scale of the integer entries.
SCALE = 256
#: Binary digits of a root, and decimal digits of the inverse iteration.
BITS = 256
DIGITS = 200
#: Entries are multiplied in parts of so many bits, for so many rows at a time: their sums are exact in doubles.
PART_BITS = 20
PART_ROWS = 4096
#: Rows after which a task hands its sums on, so that they fit a long.
SUM_ROWS = 1 << 21


# -- vectors --------------------------------------------------------------


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x array<bigint>`` of the rows whose vectors have only finite entries."""
    v = F.col(vector_col)
    usable = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * float(SCALE)))
    return df.where(usable).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches and their last column's vectors, in parts of at most ``PART_ROWS``."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            part = batch.slice(at, PART_ROWS)
            yield part, part.columns[-1].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def scatter_sums(fit: DataFrame, width: int, bits: int) -> tuple[list[list[int]], list[int]]:
    """The exact sum(x x') and sum(x) of vectors whose entries fit ``bits`` bits with their sign."""
    parts = -(-bits // PART_BITS)
    ones = width * width  # cells from here on are the sums of single dimensions
    upper = np.triu_indices(width)
    cells = upper[0] * width + upper[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(sums: dict) -> Iterator[pa.RecordBatch]:
            for shift, (cell, values) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.full(len(cell), shift[0])), pa.array(values)], ["cell", "shift", "value"])

        sums: dict[tuple[int, str], tuple[np.ndarray, np.ndarray]] = {}
        rows = 0
        for _, x in _matrices(batches, width):
            limbs = [x >> PART_BITS * k if k == parts - 1 else x >> PART_BITS * k & (1 << PART_BITS) - 1 for k in range(parts)]
            for a in range(parts):
                add = [((PART_BITS * a, "s"), np.arange(ones, ones + width), limbs[a].sum(0))]
                for b in range(parts):
                    product = (limbs[a].T.astype(float) @ limbs[b].astype(float)).astype(np.int64)
                    add.append(((PART_BITS * (a + b), f"p{a}"), cells, product[upper]))
                for key, cell, values in add:
                    sums[key] = (cell, sums[key][1] + values if key in sums else values)
            rows += len(x)
            if rows >= SUM_ROWS:
                yield from handed(sums)
                sums, rows = {}, 0
        yield from handed(sums)

    prepare_workers(fit.sparkSession)
    got = fit.select("x").mapInArrow(run, "cell bigint, shift bigint, value bigint").groupBy("cell", "shift").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    total = [0] * (ones + width)
    for cell, shift, value in got.collect():
        total[cell] += int(value) << shift
    g = [[total[min(i, j) * width + max(i, j)] for j in range(width)] for i in range(width)]
    return g, total[ones:]


# -- characteristic polynomial --------------------------------------------


def _is_prime(n: int) -> bool:
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):  # these decide below 3.2e9
        if n == a:
            return True
        x = pow(a, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product is beyond ``bound``."""
    out, product, n = [], 1, 2**31 - 1
    while product <= bound:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(xI - matrix) modulo a prime below 2**31, highest power first, by Hessenberg reduction."""
    d = len(matrix)
    h = np.array([[v % p for v in row] for row in matrix], np.int64).reshape(d, d)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(1)) % p
    # Polynomials of the leading blocks, lowest power first, each from all before it.
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    factor = np.zeros(0, np.int64)
    for m in range(1, d + 1):
        # factor[i]: the product of the subdiagonal from row i + 1 to row m - 1.
        factor = np.append(factor * h[m - 1, m - 2] % p if m > 1 else factor, 1)
        weight = factor * h[:m, m - 1] % p
        less = (weight[:, None] * blocks[:m] % p).sum(0) % p
        blocks[m, 1:] = blocks[m - 1, :-1]
        blocks[m] = (blocks[m] - less) % p
    return blocks[d, ::-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The exact coefficients of det(xI - matrix), highest power first, of a positive semidefinite integer matrix.

    Their sizes are the elementary symmetric functions of the eigenvalues, at most
    those of d equal ones with the same trace. The primes are dealt to Spark's tasks.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bound = max(math.comb(d, k) * trace**k // d**k for k in range(d + 1)) + 1
    primes = primes_for(2 * bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(ps), pa.array([polynomial_mod(matrix, p) for p in ps])], ["p", "c"])

    prepare_workers(spark)
    dealt = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    product = math.prod(primes)
    out = [0] * (d + 1)
    for p, residues in dealt.mapInArrow(run, "p bigint, c array<bigint>").collect():
        unit = product // p
        unit *= pow(unit, -1, p)
        for k, r in enumerate(residues):
            out[k] += r * unit
    return [c if (c := x % product) <= product // 2 else c - product for x in out]


def roots_above(poly: list[int], a: int, s: int) -> int:
    """How many roots (with multiplicity) of a polynomial with real roots only are above a / 2**s."""
    c = [x << s * k for k, x in enumerate(poly)]
    for stop in range(len(c), 1, -1):
        for k in range(1, stop):
            c[k] += a * c[k - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], a: int, s: int) -> int:
    value = 0
    for k, x in enumerate(poly):
        value = value * a + (x << s * k)
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int, bits: int = BITS) -> list[tuple[int, int]]:
    """The ``count`` largest roots as (a, s), a / 2**s to ``bits`` digits; equal ones have equal pairs.

    ``poly`` is monic with positive real roots only, ``count`` of them at least.
    """
    out: list[tuple[int, int]] = []
    for j in range(1, count + 1):
        if out and roots_above(poly, out[-1][0] - 1, out[-1][1]) >= j:
            out.append(out[-1])  # so close to the one before that no digit tells them apart
            continue
        # A power of two that the root is above, its double not.
        top = (-poly[1]).bit_length()
        low = top - 1
        step = 1
        while _above_power(poly, low) < j:
            low, step = low - step, step * 2
        high = top
        while high - low > 1:
            mid = (low + high) // 2
            if _above_power(poly, mid) >= j:
                low = mid
            else:
                high = mid
        s = max(0, bits - low)
        a, b = 1 << low + s, 1 << high + s
        alone = False
        while b - a > 1:
            mid = (a + b) // 2
            if not alone:
                alone = roots_above(poly, a, s) - roots_above(poly, b, s) == 1
            if alone:  # an even number of roots above a point: the value there is positive
                sign = _sign(poly, mid, s)
                over = bool(sign) and (sign > 0) == (j % 2 == 0)
            else:
                over = roots_above(poly, mid, s) >= j
            a, b = (mid, b) if over else (a, mid)
        out.append((b, s))
    return out


def _above_power(poly: list[int], e: int) -> int:
    return roots_above(poly, 1 << e, 0) if e >= 0 else roots_above(poly, 1, -e)


# -- components -----------------------------------------------------------


def null_vectors(matrix: list[list[int]], root: Decimal, count: int) -> list[list[Decimal]]:
    """``count`` orthonormal vectors that matrix - root sends (nearly) to 0, by inverse iteration in the current decimal context."""
    d = len(matrix)
    rows = [[Decimal(v) - root if i == j else Decimal(v) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
    tiny = max(max(map(abs, row)) for row in rows).scaleb(-DIGITS * 3 // 4) or Decimal(1)
    order = list(range(d))
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[best] = rows[best], rows[k]
        order[k], order[best] = order[best], order[k]
        if abs(rows[k][k]) < tiny:
            rows[k][k] = tiny
        pivot = rows[k]
        for i in range(k + 1, d):
            row = rows[i]
            if row[k]:
                f = row[k] = row[k] / pivot[k]
                row[k + 1 :] = [x - f * y for x, y in zip(row[k + 1 :], pivot[k + 1 :], strict=True)]

    def solved(v: list[Decimal]) -> list[Decimal]:
        out: list[Decimal] = []
        for i in range(d):
            out.append(v[order[i]] - sum(map(Decimal.__mul__, rows[i][:i], out)))
        for i in reversed(range(d)):
            out[i] = (out[i] - sum(map(Decimal.__mul__, rows[i][i + 1 :], out[i + 1 :]))) / rows[i][i]
        return out

    found: list[list[Decimal]] = []
    for c in range(count):
        v = [Decimal((7919 * (i + 1) ** 2 + 104729 * (c + 1) * (i + 3)) % 1009 - 504) for i in range(d)]
        for _ in range(3):
            v = solved(v)
            for _ in range(2):
                for u in found:
                    f = sum(map(Decimal.__mul__, u, v))
                    v = [x - f * y for x, y in zip(v, u, strict=True)]
                size = sum(x * x for x in v).sqrt()
                v = [x / size for x in v]
        found.append(v)
    return found


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: ``n`` distinct vectors of sum ``sums``, ``axes[k]`` a component over the root of its eigenvalue (None: 0)."""

    n: int
    width: int
    bits: int
    sums: tuple[int, ...]
    axes: tuple[tuple[float, ...] | None, ...]
    eigenvalues: tuple[float, ...]
    explained: tuple[float | None, ...]
    identity_error: float | None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: as int64 where that holds it, else as Python integers."""
        if self.bits + self.n.bit_length() + 1 > 62:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * self.n - np.array(self.sums, np.int64)

    def projected(self, centred: np.ndarray) -> np.ndarray:
        """Whitened values on the components with an eigenvalue."""
        axes = [a for a in self.axes if a is not None]
        return (centred / self.n).astype(float) @ np.array(axes, float).reshape(len(axes), self.width).T


def components(spark: SparkSession, matrix: list[list[int]], n: int, count: int) -> tuple[list, list, list]:
    """Axes, eigenvalues and explained shares of the ``count`` largest components of matrix / n**2."""
    poly = characteristic_polynomial(spark, matrix)
    while poly[-1] == 0 and len(poly) > 1:
        poly.pop()  # roots 0
    trace = -poly[1] if len(poly) > 1 else 0
    roots = largest_roots(poly, min(count, len(poly) - 1))
    axes: list[tuple[float, ...] | None] = []
    values, explained = [], []
    with localcontext(Context(prec=DIGITS)):
        for k, root in enumerate(roots):
            if k and root == roots[k - 1]:
                continue
            same = roots.count(root)
            value = Decimal(root[0]) / (1 << root[1])
            e = value / n**2
            for v in null_vectors(matrix, value, same):
                sign = 1 if max(v, key=abs) > 0 else -1
                axes.append(tuple(float(sign * x / e.sqrt()) for x in v))
                values.append(float(e))
                explained.append(float(value / trace))
    rest = count - len(axes)
    return axes + [None] * rest, values + [0.0] * rest, explained + ([0.0] if trace else [None]) * rest


def fit_whitening(vectors: DataFrame, count: int = 4) -> Whitening | None:
    """Fit on the distinct ``x`` of ``vectors`` (see ``integer_vectors``); None if there is none."""
    spark = vectors.sparkSession
    fit = stored(vectors.select("x").distinct(), "whitening-fit")
    kinds = fit.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"), F.max(F.array_max("x")).alias("hi"), F.min(F.array_min("x")).alias("lo"))
    usual = kinds.orderBy(F.desc("n"), F.desc("width")).first()
    if usual is None or not usual.width:
        return None
    n, width = usual.n, usual.width
    bits = max(usual.hi.bit_length(), (~usual.lo if usual.lo < 0 else usual.lo).bit_length()) + 1
    fit = fit.where(F.size("x") == width)
    g, s = scatter_sums(fit, width, bits)
    matrix = [[n * g[i][j] - s[i] * s[j] for j in range(width)] for i in range(width)]
    axes, values, explained = components(spark, matrix, n, min(count, width))
    model = Whitening(n, width, bits, tuple(s), tuple(axes), tuple(values), tuple(explained), None)
    error = identity_error(fit, model)
    return Whitening(n, width, bits, tuple(s), tuple(axes), tuple(values), tuple(explained), error)


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, measured on its vectors."""
    live = sum(a is not None for a in model.axes)
    if not live:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(live), np.zeros((live, live))
        for _, x in _matrices(batches, model.width):
            z = model.projected(model.centred(x))
            total += z.sum(0)
            products += z.T @ z
        values = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["cell", "value"])

    prepare_workers(fit.sparkSession)
    got = dict(fit.select("x").mapInArrow(run, "cell bigint, value double").groupBy("cell").agg(F.sum("value")).collect())
    mean = np.array([got[i] for i in range(live)]) / model.n
    covariance = np.array([got[i] for i in range(live, live + live * live)]).reshape(live, live) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(live)).max())


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened array<double>`` (one entry per component) of every vector of the usual length."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    live = [k for k, a in enumerate(model.axes) if a is not None]
    exact = 2 * (model.bits + model.n.bit_length() + 1) + model.width.bit_length() <= 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, model.width):
            y = model.centred(x)
            if exact:
                deviation = pa.array((y * y).sum(1))
            else:
                wide = (y.astype(object) ** 2).sum(1).tolist()
                deviation = pa.array([v if v < 2**63 else None for v in wide], pa.int64())
            z = np.full((len(x), len(model.axes)), np.nan)
            z[:, live] = model.projected(y)
            values = pa.array(z.ravel(), pa.float64(), mask=np.isnan(z.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(model.axes)), values)
            yield pa.RecordBatch.from_arrays([part.column(0), deviation, lists], ["vec_id", "deviation", "whitened"])

    prepare_workers(vectors.sparkSession)
    usual = vectors.where(F.size("x") == model.width)
    return usual.mapInArrow(run, f"vec_id {kind}, deviation bigint, whitened array<double>")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    model = fit_whitening(vectors)
    if model is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")

    def fixed(v: float | None) -> Column:
        return F.lit(v).cast("double")

    return whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.array(*map(fixed, model.explained))[F.col("at")].alias("explained"),
        fixed(model.identity_error).alias("identity_error"),
    )
