"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Vectors become whole numbers, x = floor(256 c). Over the distinct vectors, tasks sum x and the products of its entries
exactly; n times the products less the products of the sums is an integer matrix, n squared times the covariance. Its
characteristic polynomial is computed modulo many primes, a Spark task for some of them each (Hessenberg reduction by
similarity, then the recurrence of leading minors), and put together by Chinese remaindering under a bound on its
coefficients. The largest roots are isolated by Descartes' rule on shifted polynomials, which is exact where all roots
are real, and halved down to 200 bits. Inverse iteration with 110 digits gives the null vectors at these roots.

The driver holds sums and polynomial, whose size follows the number of dimensions, not that of the vectors.

Cases: rows whose vector is null or holds null or non-finite entries are left out, from the fit and from the result.
Vectors shorter than the longest one count as ending in zeros. Repeated vectors count once in the fit, and each of
their rows is returned. Only components of positive variance exist; with none (no rows, one distinct vector) the result
is empty. Equal eigenvalues get some orthonormal basis of their space. A deviation beyond a long is null. Rows without
an id are rows like any other; columns not named are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from itertools import count, islice
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from prepframe.llm.frames import column, steps
from prepframe.scratch import stored

STEP = 256
COMPONENTS = 4
#: Bits of a root, relative to it, and decimal digits of the inverse iteration.
ROOT_BITS, DIGITS = 200, 110
#: Bits of a number that travel as one long, and longs of a number.
PIECE, PIECES = 40, 5
#: Primes to a task.
PRIMES_PER_TASK = 8


def usable(vector: Column) -> Column:
    """No null vector, no null or non-finite entry."""
    big = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < big))


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda e: F.floor(F.lit(float(STEP)) * e.cast("double")))


def _matrix(arrays: pa.Array, width: int) -> np.ndarray:
    """Arrays of longs as rows, shorter ones ending in zeros."""
    lengths = arrays.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def products(x: np.ndarray) -> np.ndarray:
    """The exact sum of z z' over the rows of x, z being 1 and the row; Python integers."""
    z = np.column_stack([np.ones(len(x), np.int64), x])
    most = max(abs(int(z.max())), abs(int(z.min())))
    if len(x) * most * most < 1 << 53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    out = np.zeros((z.shape[1], z.shape[1]), object)
    digits = [(z >> 16 * k) & 0xFFFF for k in range(3)] + [z >> 48]  # the last one carries the sign
    floats = [d.astype(np.float64) for d in digits]
    for first in range(0, len(x), 1 << 20):
        some = [f[first : first + (1 << 20)] for f in floats]
        for a in range(4):
            for b in range(4):
                out = out + (some[a].T @ some[b]).astype(np.int64).astype(object) * (1 << 16 * (a + b))
    return out


def _sum_products(width: int):
    names = ["i", "j", *[f"p{k}" for k in range(PIECES)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in steps(batches):
            own = products(_matrix(batch.column(0), width))
            total = own if total is None else total + own
        if total is None:
            return
        i, j = np.triu_indices(width + 1)
        values = total[i, j].tolist()
        low = [[(v >> PIECE * k) & ((1 << PIECE) - 1) for v in values] for k in range(PIECES - 1)]
        pieces = [*low, [v >> PIECE * (PIECES - 1) for v in values]]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(p, pa.int64()) for p in pieces]], names=names)

    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in names[:2]] + [T.StructField(n, T.LongType()) for n in names[2:]])
    return run, schema


def scatter(fit: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and n times the products less the products of sums, over rows x."""
    run, schema = _sum_products(width)
    parts = fit.select("x").mapInArrow(run, schema)
    sums = parts.groupBy("i", "j").agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(PIECES)]).collect()
    g = np.zeros((width + 1, width + 1), object)
    for r in sums:
        g[r["i"], r["j"]] = g[r["j"], r["i"]] = sum(r[f"p{k}"] << PIECE * k for k in range(PIECES))
    n, s = g[0, 0], g[0, 1:]
    return n, s.tolist(), (n * g[1:, 1:] - np.outer(s, s)).tolist()


def _is_prime(n: int) -> bool:
    """By Miller and Rabin's test, which is certain below 2**31 with these bases."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(many: int) -> list[int]:
    """The largest ones below 2**31."""
    return list(islice((n for n in count((1 << 31) - 1, -2) if _is_prime(n)), many))


def polynomial_modulo(a: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(tI - a) modulo p, constant term first."""
    h, d = a.astype(np.int64) % p, len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[pivot, m]] = h[[m, pivot]]
            h[:, [pivot, m]] = h[:, [m, pivot]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, d + 1):
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] -= minors[k - 1] * h[k - 1, k - 1] % p
        chain = 1
        for i in range(k - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            if not chain:
                break
            minors[k] -= minors[i - 1] * (chain * int(h[i - 1, k - 1]) % p) % p
        minors[k] %= p
    return minors[d].tolist()


def characteristic_polynomial(spark: SparkSession, a: list[list[int]]) -> list[int]:
    """e_0 .. e_d of det(tI - a) = sum of (-1)**k e_k t**(d - k), for a positive semidefinite integer matrix.

    No e_k exceeds the same function of the diagonal, so primes beyond that bound determine it.
    """
    d = len(a)
    bound = [1] + [0] * d
    for i in range(d):
        for k in range(i + 1, 0, -1):
            bound[k] += bound[k - 1] * a[i][i]
    chosen = primes(max(bound).bit_length() // 30 + 1)
    shared = spark.sparkContext.broadcast(a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.array(shared.value, object)
        for batch in batches:
            out = [polynomial_modulo((own % p).astype(np.int64), p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["p", "c"])

    table = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(max(1, len(chosen) // PRIMES_PER_TASK))
    found = {r["p"]: r["c"] for r in table.mapInArrow(run, "p long, c array<long>").collect()}
    modulus = 1
    for p in chosen:
        modulus *= p
    parts = [modulus // p * pow(modulus // p, -1, p) for p in chosen]
    raw = [sum(found[p][d - k] * m for p, m in zip(chosen, parts, strict=True)) for k in range(d + 1)]
    return [(c if k % 2 == 0 else -c) % modulus for k, c in enumerate(raw)]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots, by multiplicity, of a polynomial with real roots only (highest power first) exceed a number: the
    sign changes of the polynomial shifted there."""
    c = list(poly)
    for end in range(len(c), 1, -1):
        for j in range(1, end):
            c[j] += at * c[j - 1]
    signs = [x > 0 for x in c if x]
    return sum(s != t for s, t in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], at: int) -> int:
    value = 0
    for c in poly:
        value = value * at + c
    return (value > 0) - (value < 0)


def largest_roots(e: list[int], many: int) -> tuple[list[tuple[int, int]], int]:
    """[(root times 2**shift, multiplicity)], largest first, until `many` roots are counted; zeros are left out."""
    d = len(e) - 1
    many = min(many, sum(x > 0 for x in e[1:]))
    if not many:
        return [], 0
    # the k-th root is at least e_k / (number of products in e_k * trace ** (k - 1))
    least = max(1, comb(d, many) * e[1] ** (many - 1) // e[many])
    shift = ROOT_BITS + 16 + least.bit_length()
    poly = [(x if k % 2 == 0 else -x) << shift * k for k, x in enumerate(e)]
    top = e[1] << shift
    todo, found = [(0, top, d if e[d] else sum(x > 0 for x in e[1:]), 0)], []
    counted = 0
    while todo and counted < many:
        low, high, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if inside == 1:
            while high - low > max(1, high >> ROOT_BITS):
                mid = (low + high) // 2
                sign = _sign(poly, mid)
                if sign == 0:
                    low = high = mid
                elif (sign > 0) == (above_high % 2 == 0):
                    high = mid
                else:
                    low = mid
            found.append(((low + high) // 2, 1))
            counted += 1
        elif high - low <= max(1, high >> ROOT_BITS):
            found.append((high, inside))
            counted += inside
        else:
            mid = (low + high) // 2
            above = roots_above(poly, mid)
            todo += [(low, mid, above_low, above), (mid, high, above, above_high)]
    return found, shift


def _dot(a: np.ndarray, b: np.ndarray):
    return sum((a * b).tolist(), Decimal(0))


def null_vectors(a: list[list[int]], root: Decimal, many: int) -> list[np.ndarray]:
    """Orthonormal vectors that a - root I sends nearly to zero, by inverse iteration; `root` lies beside the true one."""
    d = len(a)
    m = np.array([[Decimal(v) for v in row] for row in a], object)
    for i in range(d):
        m[i, i] -= root
    order = list(range(d))
    for k in range(d):
        pivot = max(range(k, d), key=lambda r: abs(m[r, k]))
        if pivot != k:
            m[[k, pivot]] = m[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if m[k, k] == 0:
            m[k, k] = abs(root).scaleb(-DIGITS)
        factors = m[k + 1 :, k] / m[k, k]
        m[k + 1 :, k] = factors
        m[k + 1 :, k + 1 :] = m[k + 1 :, k + 1 :] - np.outer(factors, m[k, k + 1 :])

    def solve(b: np.ndarray) -> np.ndarray:
        y = b[order]
        for k in range(d):
            y[k + 1 :] = y[k + 1 :] - m[k + 1 :, k] * y[k]
        for k in range(d - 1, -1, -1):
            y[k] = y[k] / m[k, k]
            y[:k] = y[:k] - m[:k, k] * y[k]
        return y

    out: list[np.ndarray] = []
    draw = np.random.default_rng(0)
    for _ in range(many):
        y = np.array([Decimal(int(v)) for v in draw.integers(1, 1 << 30, d)], object)
        for _ in range(3):
            y = solve(y)
            for u in out:
                y = y - u * _dot(u, y)
            y = y / _dot(y, y).sqrt()
        out.append(y if y[max(range(d), key=lambda i: abs(y[i]))] > 0 else -y)
    return out


@dataclass
class Whitening:
    """Distinct vectors, sums, unit components (rows), eigenvalues of n squared times the covariance, shares, error."""

    n: int
    sums: list[int]
    components: np.ndarray
    roots: np.ndarray
    explained: np.ndarray
    polynomial: list[int]
    identity_error: float = 0.0

    def apply(self, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """Deviations, and the whitened values of each row for each component."""
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        reach = self.n * most + max(map(abs, self.sums), default=0)
        if x.shape[1] * reach * reach < 1 << 63:
            off = x * self.n - np.array(self.sums, np.int64)
            deviations = (off * off).sum(axis=1).tolist()
        else:
            off = x.astype(object) * self.n - np.array(self.sums, object)
            deviations = [v if v < 1 << 63 else None for v in (off * off).sum(axis=1).tolist()]
        return deviations, off.astype(np.float64) @ self.components.T / np.sqrt(self.roots)

    def transform(self, df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
        """A row for each usable vector and component."""
        vectors = df.where(usable(column(vector_col))).select(column(id_col).alias("vec_id"), whole(column(vector_col)).alias("x"))
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        kinds = [vectors.schema["vec_id"].dataType, T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
        schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
        id_type, many = to_arrow_type(kinds[0]), len(self.roots)
        if not many:
            return df.sparkSession.createDataFrame([], schema)
        shared = df.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in steps(batches):
                rows = batch.num_rows
                deviations, white = own.apply(_matrix(batch.column(1), len(own.sums)))
                columns = [
                    batch.column(0).take(pa.array(np.repeat(np.arange(rows), many))).cast(id_type),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * many, own.n, np.int64)),
                    pa.array([v for v in deviations for _ in range(many)], pa.int64()),
                    pa.array(white.ravel()),
                    pa.array(np.tile(own.explained, rows)),
                    pa.array(np.full(rows * many, own.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return vectors.mapInArrow(run, schema)


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """How far the covariance of the whitened distinct vectors is from the identity, measured on them."""
    many, width = len(model.roots), len(model.sums)
    shared = fit.sparkSession.sparkContext.broadcast(model)
    names = [f"w{k}" for k in range(many)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            white = shared.value.apply(_matrix(batch.column(0), width))[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(white[:, k])) for k in range(many)], names=names)

    white = fit.select("x").mapInArrow(run, ", ".join(f"{n} double" for n in names))
    pairs = [(i, j) for i in range(many) for j in range(i, many)]
    row = white.agg(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs, strict=True))


def fit_whitening(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Learn from every distinct usable vector."""
    fit = df.where(usable(column(vector_col))).select(whole(column(vector_col)).alias("x"))
    fit = stored(fit.distinct(), "fit")
    shortest, width = fit.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if not width:
        return Whitening(0 if width is None else 1, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0), [1])
    if shortest < width:
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
        fit = stored(fit.select(F.concat("x", zeros).alias("x")).distinct(), "fit")
    n, sums, a = scatter(fit, width)
    e = characteristic_polynomial(df.sparkSession, a)
    found, shift = largest_roots(e, components)
    vectors, roots = [], []
    with localcontext() as context:
        context.prec = DIGITS
        for root, many in found:
            # a little beside the root, so that the matrix has an inverse
            value = Decimal(root) / Decimal(1 << shift)
            beside = value * (1 + Decimal(2) ** -(ROOT_BITS - 8))
            vectors += [[float(v) for v in u] for u in null_vectors(a, beside, min(many, components - len(roots)))]
            roots += [float(value)] * (len(vectors) - len(roots))
    trace = e[1] if len(e) > 1 else 0
    explained = np.array([r / trace for r in roots]) if trace else np.zeros(0)
    model = Whitening(n, sums, np.array(vectors).reshape(len(roots), width), np.array(roots), explained, e)
    if roots:
        model.identity_error = _identity_error(fit, model)
    return model
