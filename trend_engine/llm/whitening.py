"""Embedding whitening from the exact characteristic polynomial of the integer scatter matrix.

1. Every vector becomes whole numbers x = floor(64 * c) + 1000000; each distinct x vector counts once.
   Spark adds up the sums S and the products of the x exactly (whole numbers, in tasks), which gives the
   integer scatter matrix M = n * sum(x x') - S S'. The covariance is M / n^2.
2. The characteristic polynomial of M: for enough primes below 2^31, one row each, tasks reduce M to
   Hessenberg form modulo the prime and expand its polynomial; Chinese remaindering puts the exact
   coefficients together (their size is bounded through the trace).
3. All roots are real, so the sign changes of the polynomial shifted to a point (whole numbers, no
   rounding) count the roots beyond it exactly. Bisection isolates the largest ones to 2^-BITS of
   their size; roots that stay together longer are one cluster with a basis of its own.
4. A component is the null space of M - root * I: inverse iteration in DIGITS-digit decimals, made
   orthogonal to the earlier vectors of its cluster. Its sign makes its largest entry positive.
5. Tasks project every row on the components.

The driver holds only things of the vectors' dimension: sums, matrix, polynomial, components.

Cases: rows whose vector is null, or holds a null, a non-finite entry or one whose x is beyond 2^62, take no
part, and neither do empty vectors. All vectors must have one length (others raise an error that
names the lengths). Repeated rows and null ids stay rows of the result. Components with eigenvalue 0 can't
be whitened and are left out, so fewer than `most` (none for one distinct vector) may come; an empty
table gives an empty result. `deviation` is null where it passes 64 bits. Only the id and the vector
column are read, so others may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trend_engine.llm._common import table

#: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Roots are known to 2^-BITS of their size; digits of the inverse iteration, and its steps.
BITS, DIGITS, STEPS = 128, 110, 4
COMPONENTS = 16
#: Whole numbers travel as a * 2^LIMB + b, so that sums stay within 38 decimal digits.
LIMB = 60
#: Below it, sums of whole numbers in doubles are exact.
EXACT = 1 << 53


@dataclass
class Fit:
    n: int
    sums: list[int]
    scatter: list[list[int]]
    roots: list[Decimal]
    vectors: np.ndarray


# ---- whole vectors ---------------------------------------------------------------------------

def whole(df: DataFrame, vector: str, key: str) -> DataFrame:
    """(key, x less SHIFT) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    x = F.transform(v, lambda c: F.floor(c * SCALE))
    ok = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < float(1 << 62) / SCALE))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(ok).select(
        F.col(key).alias("key"), x.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _limbs(total: int) -> tuple[int, int]:
    return total >> LIMB, total & ((1 << LIMB) - 1)


def moments(x: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and sums of products of the rows of x (whole numbers, exact)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            y = _matrix(batch.column(0), d)
            if not len(y):
                continue
            big = int(np.abs(y).max())
            rows = max(1, EXACT // max(1, big * big)) if big * big < EXACT else 0
            n += len(y)
            if rows:
                for a in range(0, len(y), rows):
                    f = y[a : a + rows].astype(np.float64)
                    products += (f.T @ f).astype(np.int64).astype(object)
                    sums += y[a : a + rows].sum(0).astype(object)
            else:
                o = y.astype(object)
                products += o.T.dot(o)
                sums += o.sum(0)
        if n:
            i, j = np.triu_indices(d)
            cells = [(-1, -1, 0, n)] + [(-1, k, *_limbs(int(s))) for k, s in enumerate(sums)] + \
                    [(int(a), int(b), *_limbs(int(products[a, b]))) for a, b in zip(i, j, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
                 pa.array([Decimal(c[2]) for c in cells], pa.decimal128(38)), pa.array([Decimal(c[3]) for c in cells], pa.decimal128(38))],
                ["i", "j", "a", "b"])

    parts = x.select("x").mapInArrow(run, "i int, j int, a decimal(38,0), b decimal(38,0)")
    found = {(r.i, r.j): (int(r.a) << LIMB) + int(r.b)
             for r in parts.groupBy("i", "j").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()}
    n = found.get((-1, -1), 0)
    if not n:
        return 0, [0] * d, [[0] * d for _ in range(d)]
    return n, [found[-1, k] for k in range(d)], [[found[min(i, j), max(i, j)] for j in range(d)] for i in range(d)]


# ---- exact characteristic polynomial -----------------------------------------------------------

def _prime(p: int) -> bool:
    """Deterministic Miller-Rabin test, sufficient below 3.2 * 10^9 with these bases."""
    d, s = p - 1, 0
    while not d % 2:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        y = pow(a, d, p)
        if y in (1, p - 1):
            continue
        for _ in range(s - 1):
            y = y * y % p
            if y == p - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes below 2^31, falling, whose product has more than `bits` bits."""
    out, p, have = [], (1 << 31) - 1, 0
    while have <= bits:
        if _prime(p):
            out.append(p)
            have += p.bit_length() - 1
        p -= 2
    return out


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to `a` modulo p with nothing below its first subdiagonal."""
    h = a % p
    d = len(h)
    for j in range(d - 2):
        below = np.flatnonzero(h[j + 1 :, j])
        if not len(below):
            continue
        k = j + 1 + int(below[0])
        if k != j + 1:
            h[[j + 1, k]] = h[[k, j + 1]]
            h[:, [j + 1, k]] = h[:, [k, j + 1]]
        u = h[j + 2 :, j] * pow(int(h[j + 1, j]), -1, p) % p
        # Similarity: rows lose u times row j+1, and column j+1 gains the columns times u.
        h[j + 2 :] = (h[j + 2 :] - u[:, None] * h[j + 1] % p) % p
        h[:, j + 1] = (h[:, j + 1] + (h[:, j + 2 :] * u % p).sum(1)) % p
    return h


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(t I - a) modulo p, lowest first."""
    h = hessenberg(a, p)
    d = len(h)
    q = np.zeros((d + 1, d + 1), np.int64)
    q[0, 0] = 1
    for k in range(1, d + 1):
        q[k, 1:] = q[k - 1, :-1]
        # Expansion along column k: entry times the subdiagonal products below it.
        weight, w = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weight[i] = int(h[i, k - 1]) * w % p
            w = w * int(h[i, i - 1]) % p if i else 0
        q[k] = (q[k] - (weight[:, None] * q[:k] % p).sum(0)) % p
    return q[d]


def characteristic(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Coefficients of det(t I - M), lowest first, of a positive semi-definite integer matrix."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    # The k-th elementary symmetric function of values >= 0 is at most C(d, k) (trace / d)^k.
    bound = max(comb(d, k) * (trace ** k // d ** k + 1) for k in range(d + 1))
    ps = primes((2 * bound).bit_length() + 1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [polynomial_mod(np.array([[int(v) % p for v in row] for row in m], np.int64), p) for p in frame["p"].tolist()]
            yield pd.DataFrame({"p": frame["p"], "c": [r.tolist() for r in rows]})

    work = spark.createDataFrame([(p,) for p in ps], "p long").repartition(min(len(ps), 64))
    residues = {r.p: r.c for r in work.mapInPandas(run, "p long, c array<long>").collect()}
    out, modulus = [0] * (d + 1), 1
    for p in ps:
        inverse = pow(modulus, -1, p)
        out = [v + modulus * ((c - v) * inverse % p) for v, c in zip(out, residues[p], strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in out]


# ---- roots ----------------------------------------------------------------------------------------

def roots_beyond(poly: list[int], num: int, shift: int) -> int:
    """Number of roots greater than num / 2^shift, with multiplicity (all roots must be real)."""
    d = len(poly) - 1
    c = [v << shift * (d - k) for k, v in enumerate(poly)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += num * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(poly: list[int], most: int) -> list[tuple[int, int, int, int]]:
    """Intervals (low, high, shift, count) that hold the `most` largest positive roots, falling: the
    `count` roots of one lie in (low, high] / 2^shift, whose width is at most 2^-BITS of them."""
    zeros = next((k for k, c in enumerate(poly) if c), len(poly) - 1)
    poly = poly[zeros:]
    d = len(poly) - 1
    if not d:
        return []
    high = 1 << max(1, max(abs(c) for c in poly).bit_length())
    # Sum of the roots bounds each of them.
    high = min(high, -poly[-2] + 1)
    todo, out, have = [(0, high, 0, d, 0)], [], 0
    while todo and have < most:
        low, top, shift, inside, above = todo.pop()
        if inside == 1:
            low, top, shift = _narrowed(poly, low, top, shift)
        if low and (top - low) << BITS <= low:
            out.append((low, top, shift, inside))
            have += inside
            continue
        low, top, shift = low << 1, top << 1, shift + 1
        mid = (low + top) >> 1
        upper = roots_beyond(poly, mid, shift) - above
        if inside - upper:
            todo.append((low, mid, shift, inside - upper, above + upper))
        if upper:
            todo.append((mid, top, shift, upper, above))
    return out


def _sign(poly: list[int], num: int, shift: int) -> int:
    value = 0
    for k in range(len(poly) - 1, -1, -1):
        value = value * num + (poly[k] << shift * (len(poly) - 1 - k))
    return (value > 0) - (value < 0)


def _narrowed(poly: list[int], low: int, top: int, shift: int) -> tuple[int, int, int]:
    """The interval of a single root, halved by the polynomial's sign alone."""
    end = _sign(poly, top, shift)
    if not end:
        return (top << BITS) - 1, top << BITS, shift + BITS
    while not low or (top - low) << BITS > low:
        low, top, shift = low << 1, top << 1, shift + 1
        mid = (low + top) >> 1
        s = _sign(poly, mid, shift)
        if not s:
            return (mid << BITS) - 1, mid << BITS, shift + BITS
        low, top = (low, mid) if s == end else (mid, top)
    return low, top, shift


# ---- components -------------------------------------------------------------------------------------

def _factors(a: list[list[Decimal]]) -> tuple[list[list[Decimal]], list[int]]:
    """Triangular factors with row exchanges; a pivot that vanishes becomes tiny."""
    d, order = len(a), list(range(len(a)))
    a = [row[:] for row in a]
    tiny = max(abs(v) for row in a for v in row) * Decimal(10) ** -(DIGITS - 5)
    for k in range(d):
        p = max(range(k, d), key=lambda r: abs(a[r][k]))
        a[k], a[p], order[k], order[p] = a[p], a[k], order[p], order[k]
        if abs(a[k][k]) < tiny:
            a[k][k] = tiny
        for r in range(k + 1, d):
            f = a[r][k] = a[r][k] / a[k][k]
            if f:
                row, pivot = a[r], a[k]
                for c in range(k + 1, d):
                    row[c] -= f * pivot[c]
    return a, order


def _solve(lu: tuple[list[list[Decimal]], list[int]], b: list[Decimal]) -> list[Decimal]:
    a, order = lu
    d, y = len(b), [b[r] for r in order]
    for r in range(d):
        y[r] -= sum((a[r][c] * y[c] for c in range(r)), Decimal(0))
    for r in range(d - 1, -1, -1):
        y[r] = (y[r] - sum((a[r][c] * y[c] for c in range(r + 1, d)), Decimal(0))) / a[r][r]
    return y


def _unit(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    for _ in range(2):
        for o in others:
            dot = sum(a * b for a, b in zip(v, o, strict=True))
            v = [a - dot * b for a, b in zip(v, o, strict=True)]
        size = sum(a * a for a in v).sqrt()
        v = [a / size for a in v]
    return v


def null_space(m: list[list[int]], root: Decimal, count: int, rng: np.random.Generator) -> list[list[Decimal]]:
    """`count` orthonormal vectors that M - root * I all but kills."""
    d = len(m)
    lu = _factors([[Decimal(m[i][j]) - (root if i == j else 0) for j in range(d)] for i in range(d)])
    out: list[list[Decimal]] = []
    for _ in range(count):
        v = _unit([Decimal(int(x)) for x in rng.integers(1, 1 << 30, d) - (1 << 29)], out)
        for _ in range(STEPS):
            v = _unit(_solve(lu, v), out)
        out.append(v)
    return out


def components(m: list[list[int]], poly: list[int], most: int) -> tuple[list[Decimal], np.ndarray]:
    """The largest eigenvalues of M and their unit vectors as columns."""
    rng, roots, vectors = np.random.default_rng(13), [], []
    with localcontext(Context(prec=DIGITS)):
        for low, top, shift, count in largest_roots(poly, most):
            root = (Decimal(low) + Decimal(top)) / (Decimal(2) * Decimal(1 << shift))
            for v in null_space(m, root, count, rng):
                lead = max(v, key=abs)
                roots.append(root)
                vectors.append([float(a if lead > 0 else -a) for a in v])
    return roots[:most], np.array(vectors[:most], np.float64).reshape(-1, len(m)).T


def fit(x: DataFrame, most: int = COMPONENTS) -> Fit | None:
    """Sums, scatter matrix and components of the distinct vectors of `x` (None without any)."""
    sizes = [r.d for r in x.select(F.size("x").alias("d")).distinct().limit(3).collect()]
    if not sizes:
        return None
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes)}")
    n, sums, products = moments(x, sizes[0])
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(sizes[0])] for i in range(sizes[0])]
    poly = characteristic(x.sparkSession, scatter)
    roots, vectors = components(scatter, poly, most)
    return Fit(n, sums, scatter, roots, vectors)


def _whiten(y: np.ndarray, f: Fit) -> tuple[np.ndarray, list]:
    """Whitened coordinates and exact deviations of whole vectors."""
    scale = np.array([float(Decimal(f.n) / r.sqrt()) for r in f.roots])
    big = max(int(np.abs(y).max(initial=0)) * f.n + max(abs(s) for s in f.sums), 1)
    if big < 1 << 62:
        centred = y * f.n - np.array(f.sums, np.int64)
    else:
        centred = y.astype(object) * f.n - np.array(f.sums, object)
    z = (centred.astype(np.float64) / f.n) @ f.vectors * scale
    if big * big * y.shape[1] < 1 << 63:
        return z, (centred * centred).sum(1).tolist()
    deviation = (centred.astype(object) ** 2).sum(1)
    return z, [int(v) if v < 1 << 63 else None for v in deviation]


def identity_error(x: DataFrame, f: Fit) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = len(f.roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, outer = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z, _ = _whiten(_matrix(batch.column(0), len(f.sums)), f)
            total += z.sum(0)
            outer += z.T @ z
        i, j = np.triu_indices(k)
        cells = [*[(-1, a, total[a]) for a in range(k)], *[(int(a), int(b), outer[a, b]) for a, b in zip(i, j, strict=True)]]
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
                                          pa.array([float(c[2]) for c in cells])], ["i", "j", "v"])

    sums = {(r.i, r.j): r.v for r in x.select("x").mapInArrow(run, "i int, j int, v double")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    return max(abs(v / f.n - sums[-1, i] * sums[-1, j] / f.n ** 2 - (i == j)) for (i, j), v in sums.items() if i >= 0)


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """One row per row and component: id, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    x = whole(df, vector, key)
    once = table(x.select("x").distinct(), "whole-vectors")
    f = fit(once, most)
    if f is None or not f.roots:
        return spark.createDataFrame([], schema)
    trace = sum(f.scatter[i][i] for i in range(len(f.sums)))
    explained = [float(r / trace) for r in f.roots]
    error = identity_error(once, f)
    k, names = len(f.roots), spark.createDataFrame([], schema).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, deviation = _whiten(_matrix(batch.column(1), len(f.sums)), f)
            row = np.repeat(np.arange(len(z)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z))),
                 pa.array(np.full(len(row), f.n)), pa.array(deviation, pa.int64()).take(pa.array(row)), pa.array(z.ravel()),
                 pa.array(np.tile(explained, len(z))), pa.array(np.full(len(row), error))], names)

    return x.mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
