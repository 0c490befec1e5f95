"""Whitening of vectors from the exact characteristic polynomial of their integer scatter.

Vectors become integers, so the scatter matrix is exact.  Its characteristic
polynomial is found modulo many primes (Hessenberg reduction; a Spark task
takes a share of the primes) and put together by Chinese remainders.  All its
roots are real, so Descartes' rule counts them exactly: the roots above x are
the sign changes of the polynomial shifted by x.  Roots are isolated so, then
refined by bisection to far more digits than a double has.  Components are
null vectors of scatter - root, by inverse iteration in long fixed point; a
Spark task takes a share of the roots.
"""

from __future__ import annotations

from decimal import Decimal
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.session import materialize

#: Added to every scaled component.
SHIFT = 1_000_000
#: Bits kept of a root beyond the largest one's magnitude, of quotients in eliminations, rounds of inverse iteration.
_ROOT_BITS, _QUOTIENT_BITS, _ROUNDS = 192, 384, 3
#: Scaled components are held within this, so that all integers fit a long.
_LIMIT = 1 << 61


class Whitening(NamedTuple):
    """What ``fit`` found: fitted vectors and their sums, components by falling eigenvalue, the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: list[float]
    explained: list[float]
    identity_error: float | None


# ---- vectors as integers -------------------------------------------------------------------------------------------

def integers(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows kept (not null, every entry finite) and floor(scale * entry) + 1000000 of theirs."""
    if not len(vectors):
        return np.zeros(0, bool), np.empty((0, 0), np.int64)
    sizes = np.array(vectors.value_lengths().fill_null(0))
    values = np.array(vectors.flatten().cast(pa.float64()).fill_null(float("nan")), float)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    stop = np.cumsum(sizes)
    keep = np.array(vectors.is_valid()) & (bad[stop] == bad[stop - sizes])
    widths = np.unique(sizes[keep])
    if len(widths) > 1:
        raise ValueError(f"vectors of {widths[0]} and of {widths[-1]} entries in one table")
    with np.errstate(over="ignore"):
        floor = np.clip(np.floor(values[np.repeat(keep, sizes)] * scale), -_LIMIT, _LIMIT)
    return keep, floor.astype(np.int64).reshape(int(keep.sum()), int(widths[0]) if len(widths) else 0) + SHIFT


def _packed(column: str, scale: int):
    """Integers of kept rows as bytes, each distinct vector of a batch once."""
    def run(batches):
        for batch in batches:
            _, rows = integers(batch.column(column), scale)
            if rows.size:
                rows = np.unique(rows, axis=0)
            yield pa.record_batch([pa.array([r.tobytes() for r in rows.astype("<i8")], pa.binary())], ["x"])
    return run


def _matrix(batch) -> np.ndarray:
    raw = batch.column("x").to_pylist()
    return np.frombuffer(b"".join(raw), "<i8").reshape(len(raw), -1)


def _column_sums(batches):
    total, n = None, 0
    for batch in batches:
        if batch.num_rows:
            rows = _matrix(batch)
            # halves of 32 bits keep the sums exact whatever the size
            here = [(int(a) << 32) + int(b) for a, b in zip((rows >> 32).sum(axis=0), (rows & 0xFFFFFFFF).sum(axis=0))]
            total, n = here if total is None else [a + b for a, b in zip(total, here)], n + len(rows)
    if n:
        yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38)),
                               pa.array([n] * len(total), pa.int64())], ["i", "total", "n"])


def gram(rows: np.ndarray) -> np.ndarray:
    """Exact products of the columns of a 64-bit integer matrix, as Python integers.

    Floating-point products are exact below 2^53: rows are taken in blocks
    that stay below, large numbers in 64 bits or Python's integers.
    """
    most = max(abs(int(rows.min())), abs(int(rows.max()))) if rows.size else 0
    total = np.zeros((rows.shape[1],) * 2, object)
    if most * most < 1 << 46:
        for a in range(0, len(rows), 128):
            part = rows[a:a + 128].astype(float)
            total += (part.T @ part).astype(np.int64)
    elif most * most < 1 << 56:
        for a in range(0, len(rows), 64):
            total += rows[a:a + 64].T @ rows[a:a + 64]
    else:
        whole = rows.astype(object)
        total += whole.T @ whole
    return total


def _products(centre: list[int]):
    """Upper triangle of the products of the vectors less ``centre``: one row for each line of it and task."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                here = gram(_matrix(batch) - np.array(centre, np.int64))
                total = here if total is None else total + here
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(map(Decimal, total[i, j].tolist()), pa.decimal128(38))], ["i", "j", "total"])
    return run


# ---- characteristic polynomial ---------------------------------------------------------------------------------------

def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 3.4e14."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7, 11, 13, 17)):
        return n in (2, 3, 5, 7, 11, 13, 17)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7, 11, 13, 17):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, falling, whose product is over ``bound``."""
    out, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def charpoly_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x I - matrix) modulo the prime ``p``, the constant first.

    Similarity steps bring the matrix to Hessenberg form; the polynomials of
    its leading blocks follow from one another.  Products of two residues fit
    64 bits, as p is below 2^31.
    """
    h = np.array(matrix % p, np.int64)
    d = len(h)
    for k in range(d - 2):
        pivots = np.flatnonzero(h[k + 1:, k])
        if not len(pivots):
            continue
        r = k + 1 + int(pivots[0])
        if r != k + 1:
            h[[k + 1, r]] = h[[r, k + 1]]
            h[:, [k + 1, r]] = h[:, [r, k + 1]]
        factor = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:, k:] = (h[k + 2:, k:] - factor[:, None] * h[k + 1, k:] % p) % p
        # the inverse step on the columns: column k+1 gains the others times their factors
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factor % p).sum(axis=1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, np.int64)
        new[1:] = poly[k, :-1]
        weights, below = [], 1
        for i in range(k, -1, -1):
            weights.append(int(h[i, k]) * below % p)
            below = below * int(h[i, i - 1]) % p if i else 0
        products = np.array(weights[::-1], np.int64)[:, None] * poly[:k + 1] % p
        poly[k + 1] = (new - products.sum(axis=0)) % p
    return poly[d].tolist()


def chinese_remainder(residues: list[list[int]], primes: list[int]) -> list[int]:
    """The integers nearest to zero with these residues by prime."""
    product, out = 1, [0] * len(residues[0])
    for row, p in zip(residues, primes):
        inverse = pow(product % p, -1, p)
        out = [x + product * ((r - x) * inverse % p) for x, r in zip(out, row)]
        product *= p
    return [x - product if 2 * x > product else x for x in out]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients for a symmetric integer matrix without negative eigenvalues, the constant first.

    The absolute coefficients sum to the product of 1 + eigenvalue, at most
    (1 + trace / d)^d, which bounds the primes needed.
    """
    d = len(matrix)
    primes = primes_beyond(2 * (2 + int(sum(matrix.diagonal())) // d) ** d)
    task = lambda batches: (pa.record_batch([
        batch.column("id"), pa.array([charpoly_mod(matrix, primes[i]) for i in batch.column("id").to_pylist()], pa.list_(pa.int64()))], ["id", "residues"])
        for batch in batches)
    shares = max(1, min(len(primes), 2 * spark.sparkContext.defaultParallelism))
    found = spark.range(0, len(primes), 1, shares).mapInArrow(task, "id long, residues array<long>")
    residues = {r["id"]: r["residues"] for r in found.toArrow().to_pylist()}
    return chinese_remainder([residues[i] for i in range(len(primes))], primes)


# ---- roots -----------------------------------------------------------------------------------------------------------

def roots_above(poly: list[int], x: int) -> int:
    """How many roots of the real-rooted ``poly`` are above ``x``, with multiplicity (Descartes, exact here)."""
    shifted = list(poly)
    d = len(poly) - 1
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            shifted[j] += x * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(poly: list[int], x: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * x + c
    return out


def largest_roots(poly: list[int], count: int, trace: int) -> tuple[list[tuple[int, int]], int]:
    """The ``count`` largest positive roots as (twice the root rounded, multiplicity), and the bits after the point.

    ``poly`` is monic with real roots, none negative, that sum to ``trace``.
    A root lies within one unit of 2^-(bits) of what is returned.  Roots that
    no unit parts count as one of their joint multiplicity.
    """
    d = len(poly) - 1
    positive = d - next((k for k, c in enumerate(poly) if c), d)
    count = min(count, positive)
    bits = max(0, _ROOT_BITS - trace.bit_length())
    scaled = [c << (bits * (d - k)) for k, c in enumerate(poly)]
    top = (trace << bits) + 1
    out, found = [], 0
    stack = [(0, top, positive, 0)]  # (low, high] with the numbers of roots above each end
    while stack and found < count:
        low, high, above_low, above_high = stack.pop()
        inside = above_low - above_high
        if not inside or above_high >= count:
            continue
        if inside == 1 and high - low > 1 and _value(scaled, high) != 0 and _value(scaled, low) != 0:
            sign = _value(scaled, high) > 0
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (low, middle) if (_value(scaled, middle) > 0) == sign else (middle, high)
        if high - low == 1:
            out.append((2 * high - 1, inside))
            found += inside
            continue
        middle = (low + high) // 2
        above = roots_above(scaled, middle)
        stack += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return out, bits


# ---- components ------------------------------------------------------------------------------------------------------

def null_vectors(matrix: np.ndarray, twice: int, bits: int, count: int) -> np.ndarray:
    """``count`` orthonormal vectors that scatter - root sends nearly to zero, by inverse iteration.

    ``twice`` / 2^(bits + 1) is the root.  All numbers are Python integers:
    the shifted matrix is exact, quotients carry 384 further bits.  The matrix
    is never singular, as its eigenvalues are no odd multiples of 2^-(bits+1)
    unless they are not rational; a pivot that vanishes counts as one unit.
    """
    d = len(matrix)
    a = matrix.astype(object) << (bits + 1)
    a[np.arange(d), np.arange(d)] -= twice
    a = a << _QUOTIENT_BITS
    order, lower = np.arange(d), np.zeros((d, d), object)
    for k in range(d):
        r = k + int(np.argmax(np.abs(a[k:, k])))
        if r != k:
            a[[k, r]], lower[[k, r]], order[[k, r]] = a[[r, k]], lower[[r, k]], order[[r, k]]
        if a[k, k] == 0:
            a[k, k] = 1
        if k + 1 < d:
            lower[k + 1:, k] = (a[k + 1:, k] << _QUOTIENT_BITS) // a[k, k]
            a[k + 1:, k:] -= (lower[k + 1:, k][:, None] * a[k, k:]) >> _QUOTIENT_BITS
    one = 1 << _QUOTIENT_BITS
    vectors = [np.array([(one * ((7 * i * (c + 1) + 3 * c + i * i) % 101 + 1)) // 101 for i in range(d)], object) for c in range(count)]
    for _ in range(_ROUNDS):
        for c in range(count):
            y = vectors[c][order]
            for k in range(1, d):
                y[k] -= (lower[k, :k] * y[:k]).sum() >> _QUOTIENT_BITS
            x = np.zeros(d, object)
            grow = a[0, 0].bit_length() + 2 * _QUOTIENT_BITS
            for k in range(d - 1, -1, -1):
                x[k] = ((y[k] << grow) - (a[k, k + 1:] * x[k + 1:]).sum()) // a[k, k]
            vectors[c] = _unit(x, vectors[:c])
    return np.array([[float(v) / one if abs(v) < 1 << 1000 else v / one for v in x] for x in vectors])


def _unit(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """``x`` less its part along ``others``, of length one (fixed point)."""
    one = 1 << _QUOTIENT_BITS
    for turn in range(2):
        most = max(map(abs, x.tolist())).bit_length()
        x = x << max(0, 2 * _QUOTIENT_BITS - most) if most < 2 * _QUOTIENT_BITS else x >> (most - 2 * _QUOTIENT_BITS)
        for o in others:
            x = x - ((((x * o).sum() >> _QUOTIENT_BITS) * o) >> _QUOTIENT_BITS)
        length = isqrt(int((x * x).sum())) or 1
        x = np.array([(v * one) // length for v in x.tolist()], object)
    return x


def principal_components(spark: SparkSession, matrix: np.ndarray, count: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Unit eigenvectors by falling eigenvalue, and each eigenvalue as (numerator, power of two below it).

    Only positive eigenvalues have a component, ``count`` at most.
    """
    trace = int(sum(matrix.diagonal())) if len(matrix) else 0
    if not trace:
        return np.empty((0, len(matrix))), []
    roots, bits = largest_roots(characteristic_polynomial(spark, matrix), count, trace)
    task = lambda batches: (pa.record_batch([
        batch.column("id"), pa.array([null_vectors(matrix, roots[i][0], bits, roots[i][1]).tolist() for i in batch.column("id").to_pylist()],
                                     pa.list_(pa.list_(pa.float64())))], ["id", "vectors"]) for batch in batches)
    found = spark.range(0, len(roots), 1, len(roots)).mapInArrow(task, "id long, vectors array<array<double>>").toArrow().to_pylist()
    vectors = {r["id"]: r["vectors"] for r in found}
    flat = [(v, (twice, bits + 1)) for i, (twice, _) in enumerate(roots) for v in vectors[i]][:count]
    return np.array([v for v, _ in flat]), [e for _, e in flat]


# ---- fit and transform -----------------------------------------------------------------------------------------------

def _project(rows: np.ndarray, n: int, sums: list[int], components: np.ndarray, eigenvalues: list[float]) -> np.ndarray:
    """(x - S/n) on each component over the root of its eigenvalue; the difference is rounded once."""
    whole = [s // n for s in sums]
    rest = np.array([(s - n * w) / n for s, w in zip(sums, whole)])
    return ((rows - np.array(whole, np.int64)).astype(float) - rest) @ components.T / np.sqrt(eigenvalues)


def _spread(fitted: Whitening):
    """Sums of the whitened values and of their products over the fit list."""
    def run(batches):
        k = len(fitted.components)
        first, second, n = np.zeros(k), np.zeros((k, k)), 0
        for batch in batches:
            if batch.num_rows:
                w = _project(_matrix(batch), fitted.n, fitted.sums, fitted.components, fitted.eigenvalues)
                first, second, n = first + w.sum(axis=0), second + w.T @ w, n + len(w)
        if n:
            i, j = np.indices((k, k)).reshape(2, -1)
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(second.ravel()), pa.array(np.repeat(first, k))],
                                  ["i", "j", "product", "total"])
    return run


def fit(vectors: DataFrame, *, column: str = "embedding", components: int = 16, scale: int = 64) -> Whitening:
    """Components of the distinct integer vectors floor(scale * entry) + 1000000 of ``vectors``.

    Vectors that are null or hold a null or an entry that is not finite are
    left out; entries past 2^61 / scale count as that.  Vectors are made
    distinct batch by batch before the one shuffle, so a vector that most rows
    share costs a row a batch.  Sums, then products of the vectors less the
    integers below their means, are exact and added up over the tasks (d^2
    sums, never vectors, reach the driver).  Only directions in which the
    vectors vary have a component: none for fewer than two distinct vectors,
    an empty table or vectors without entries.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{column}`").alias("v"))
    fitted = materialize(rows.mapInArrow(_packed("v", scale), "x binary").distinct())
    sums = fitted.mapInArrow(_column_sums, "i int, total decimal(38,0), n long").groupBy("i").agg(F.sum("total"), F.sum("n")).collect()
    if not sums:
        return Whitening(fitted.count(), [], np.empty((0, 0)), [], [], None)
    sums = sorted(sums)
    n, total = int(sums[0][2]), [int(s[1]) for s in sums]
    d, centre = len(total), [t // n for t in total]
    products = fitted.mapInArrow(_products(centre), "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total")).collect()
    rest = np.array([t - n * c for t, c in zip(total, centre)], object)
    scatter = np.zeros((d, d), object)
    for i, j, value in products:
        scatter[i, j] = scatter[j, i] = int(value)
    scatter = n * scatter - np.outer(rest, rest)  # n^2 times the covariance, exactly
    vectors_, values = principal_components(spark, scatter, components)
    trace = int(sum(scatter.diagonal()))
    eigenvalues = [e / ((n * n) << b) for e, b in values]
    found = Whitening(n, total, vectors_, eigenvalues, [e / (trace << b) for e, b in values], None)
    if not values:
        return found
    spread = fitted.mapInArrow(_spread(found), "i int, j int, product double, total double").groupBy("i", "j") \
        .agg(F.sum("product"), F.sum("total")).collect()
    means = {i: t / n for i, _, _, t in spread}
    return found._replace(identity_error=max(abs(p / n - means[i] * means[j] - (i == j)) for i, j, p, _ in spread))


def whiten(vectors: DataFrame, fitted: Whitening, *, column: str = "embedding", scale: int = 64) -> DataFrame:
    """Every kept row of ``vectors`` with ``whitened`` (a double for each component) and ``deviation``.

    ``deviation`` is the sum over the entries of (n x - S)^2 as an exact
    decimal, null past 38 digits.  Columns of those names are replaced, all
    others stay; rows are left out as in ``fit``, repeated ones stay.  Nothing
    is shuffled.
    """
    names = [c for c in vectors.columns if c not in ("whitened", "deviation")]
    kept = vectors.select(*[F.col(f"`{c}`") for c in names])

    def run(batches):
        for batch in batches:
            keep, rows = integers(batch.column(column), scale)
            if not len(rows):
                continue
            n, sums = fitted.n, np.array(fitted.sums, object)
            most = max([abs(int(v)) for v in (rows.min(axis=0, initial=1 << 62), rows.max(axis=0, initial=-(1 << 62))) for v in v], default=0)
            if len(sums) and (n * most + max(map(abs, fitted.sums))) ** 2 * len(sums) < 1 << 62 or not len(sums):
                away = rows * n - sums.astype(np.int64)
                deviation = pa.array((away * away).sum(axis=1)).cast(pa.decimal128(38))
            else:
                away = rows.astype(object) * n - sums
                deviation = pa.array([Decimal(v) if v < 10 ** 38 else None for v in (away * away).sum(axis=1).tolist()], pa.decimal128(38))
            white = _project(rows, n, fitted.sums, fitted.components, fitted.eigenvalues) if len(fitted.components) else np.empty((len(rows), 0))
            offsets = pa.array(np.arange(len(rows) + 1) * white.shape[1], pa.int32())
            yield pa.record_batch([*batch.filter(pa.array(keep)).columns, pa.ListArray.from_arrays(offsets, pa.array(white.ravel())), deviation],
                                  [*names, "whitened", "deviation"])
    schema = T.StructType([*kept.schema.fields]).add("whitened", T.ArrayType(T.DoubleType())).add("deviation", "decimal(38,0)")
    return kept.mapInArrow(run, schema)
