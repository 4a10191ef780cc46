"""Whitening of embeddings by exact integer algebra.

Vectors are read as integers, so their scatter matrix is a matrix of integers that Spark adds up exactly, whatever the
number of rows. From there on nothing grows with the corpus:

1. the characteristic polynomial of the scatter is worked out modulo primes, each by reduction to Hessenberg form (one
   Spark task takes some primes), and put together by the Chinese remainder theorem: exact;
2. its roots are all real, so the sign changes of the polynomial shifted by `a` count the roots above `a` exactly. Halving
   intervals isolates the largest roots, and signs refine them to `BITS` bits;
3. a component is the null space of scatter minus root, found by inverse iteration in long decimals (one task takes some
   roots). Roots that are equal, or so close that no double tells them apart, share a null space and are made orthogonal.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import arrow_map, stored, with_columns

COMPONENTS = 32
# x = floor(SCALE * entry) + SHIFT. Covariances do not depend on the shift, so sums are kept without it.
SCALE, SHIFT = 64, 1_000_000
# Entries whose x is not a long have no place in the result.
LARGEST = 2.0**62
# Roots are known to this many bits below the trace; those within 2 ** -CLOSE of it share a null space.
BITS, CLOSE = 192, 100
# Rows added up in one go, and the magnitude up to which doubles add up their products exactly.
ROWS, EXACT, LIMB = 4096, 1 << 20, 48
# Lengths of vectors that a task adds up at the same time.
LENGTHS = 16

Matrix = list[list[int]]
GRAM = "dim int, i int, j int, limb int, value bigint"


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of lists: the places and lengths of rows without NULL or non-finite entries, and all entries as
    floor(SCALE * entry), the entries of one row after those of another."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(SCALE * flat)
        fits = np.abs(scaled) < LARGEST
    present = np.flatnonzero(lengths >= 0)
    owner = np.repeat(np.arange(len(present)), lengths[present])
    good = np.bincount(owner[~fits], minlength=len(present)) == 0
    places = present[good]
    return places, lengths[places], np.where(fits, scaled, 0.0).astype(np.int64)[good[owner]]


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places of the rows of this length, and their integers as a matrix."""
    places, lengths, entries = vectors(column)
    for dim in np.unique(lengths).tolist():
        chosen = lengths == dim
        yield dim, places[chosen], entries[np.repeat(chosen, lengths)].reshape(int(chosen.sum()), dim)


def exact_gram(rows: np.ndarray) -> np.ndarray:
    """Sums of products of columns, as Python integers."""
    d = rows.shape[1]
    total = np.zeros((d, d), object)
    for part in (rows[k : k + ROWS] for k in range(0, len(rows), ROWS)):
        if np.abs(part).max(initial=0) < EXACT:
            limbs = [part]
        else:
            limbs = [part & (EXACT - 1), part >> 20 & (EXACT - 1), part >> 40 & (EXACT - 1), part >> 60]
        floats = [limb.astype(np.float64) for limb in limbs]
        for a, left in enumerate(floats):
            for b, right in enumerate(floats):
                total = total + ((left.T @ right).astype(np.int64).astype(object) << 20 * (a + b))
    return total


def exact_sums(rows: np.ndarray) -> np.ndarray:
    low, high = rows & 0xFFFFFFFF, rows >> 32
    return low.sum(axis=0).astype(object) + (high.sum(axis=0).astype(object) << 32)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count (i = j = -1), sums (j = -1) and sums of products (i <= j) per length, cut into limbs that fit a long."""
    held: dict[int, list] = {}

    def flush() -> pa.RecordBatch:
        out = []
        for dim, (n, sums, gram) in held.items():
            values = [(-1, -1, n), *((i, -1, s) for i, s in enumerate(sums))]
            values += [(i, j, gram[i, j]) for i in range(dim) for j in range(i, dim)]
            for i, j, value in values:
                sign, size, limb = (-1 if value < 0 else 1), abs(int(value)), 0
                while size:
                    out.append((dim, i, j, limb, sign * (size & ((1 << LIMB) - 1))))
                    size >>= LIMB
                    limb += 1
        held.clear()
        kinds = [pa.int32()] * 4 + [pa.int64()]
        columns = zip(*out, strict=True) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["dim", "i", "j", "limb", "value"])

    for batch in batches:
        for dim, _, rows in by_length(batch.column(1)):
            if dim not in held and len(held) == LENGTHS:
                yield flush()
            n, sums, gram = held.get(dim, (0, 0, 0))
            held[dim] = [n + len(rows), sums + exact_sums(rows), gram + exact_gram(rows)]
    yield flush()


def scatter(rows: DataFrame, vector_col: str) -> tuple[int, list[int], Matrix]:
    """Number of vectors, sums per dimension, and n * sum(y y') - sum(y) sum(y)' for their integers y, all exact.

    Only vectors of the commonest length count (of equally common ones the longest). What reaches the driver depends on
    that length alone.
    """
    plain = rows.select(F.lit(0).alias("c"), F.col(vector_col).alias("v"))
    parts = arrow_map(plain, _grams, GRAM).groupBy("dim", "i", "j", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    parts = stored(parts, "grams")
    count = F.sum(F.col("value") * F.pow(F.lit(2.0), F.col("limb") * LIMB))
    commonest = parts.where("i = -1").groupBy("dim").agg(count.alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if commonest is None:
        return 0, [], []
    d, found = commonest.dim, {}
    for r in parts.where(F.col("dim") == d).collect():
        found[r.i, r.j] = found.get((r.i, r.j), 0) + (int(r.value) << LIMB * r.limb)
    n, sums = found[-1, -1], [found.get((i, -1), 0) for i in range(d)]
    return n, sums, [[n * found.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j] for j in range(d)] for i in range(d)]


def primes(bits: int) -> list[int]:
    """Primes below 2 ** 31, the largest first, with a product of more than ``bits`` bits."""
    out, total, candidate = [], 0.0, (1 << 31) + 1
    while total <= bits:
        candidate -= 2
        if _is_prime(candidate):
            out.append(candidate)
            total += math.log2(candidate)
    return out


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test with the bases 2, 3, 5, 7, which decide all numbers below 3.2e9."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def polynomials(matrix: Matrix, moduli: list[int]) -> np.ndarray:
    """Coefficients (constant first) of det(xI - matrix) modulo each prime: reduction to Hessenberg form by similarity,
    then the recurrence over its leading minors. All primes go through the same steps at once."""
    d, p = len(matrix), np.asarray(moduli, np.int64)
    h = np.asarray([[[x % q for x in row] for row in matrix] for q in moduli], np.int64).reshape(len(moduli), d, d)
    every, wide = np.arange(len(p)), p[:, None, None]
    for m in range(1, d - 1):
        pivot = m + np.argmax(h[:, m:, m - 1] != 0, axis=1)
        for axis in (1, 2):
            moved = np.swapaxes(h, 1, axis)  # a view: rows first, then columns
            moved[every, m], moved[every, pivot] = moved[every, pivot], moved[every, m].copy()
        inverse = np.asarray([pow(x, -1, q) if x else 0 for x, q in zip(h[:, m, m - 1].tolist(), moduli, strict=True)], np.int64)
        factor = h[:, m + 1 :, m - 1] * inverse[:, None] % p[:, None]
        h[:, m + 1 :] = (h[:, m + 1 :] - factor[:, :, None] * h[:, m : m + 1] % wide) % wide
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1 :] * factor[:, None, :] % wide).sum(axis=2)) % p[:, None]
    minors = np.zeros((d + 1, len(p), d + 1), np.int64)
    minors[0, :, 0] = 1
    for m in range(1, d + 1):
        now = np.roll(minors[m - 1], 1, axis=1) - h[:, m - 1, m - 1, None] * minors[m - 1] % p[:, None]
        product = np.ones(len(p), np.int64)
        for i in range(1, m):
            product = product * h[:, m - i, m - i - 1] % p
            now -= (product * h[:, m - i - 1, m - 1] % p)[:, None] * minors[m - i - 1] % p[:, None]
        minors[m] = now % p[:, None]
    return minors[d]


def characteristic_polynomial(spark: SparkSession, matrix: Matrix) -> list[int]:
    """Exact coefficients of det(xI - matrix), constant first, of a symmetric matrix without negative eigenvalues.

    Such a matrix has coefficients of at most binomial(d, k) * (trace / d) ** k, which tells how many primes are needed.
    """
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    size = max(math.log2(math.comb(d, k)) + k * math.log2(max(trace, d) / d) for k in range(d + 1))
    moduli = primes(math.ceil(size) + 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            residues = polynomials(matrix, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(residues.tolist(), pa.list_(pa.int64()))], ["prime", "residues"])

    tasks = min(len(moduli), spark.sparkContext.defaultParallelism)
    rows = arrow_map(spark.createDataFrame([(p,) for p in moduli], "prime bigint").repartition(tasks), run, "prime bigint, residues array<bigint>")
    whole, out = math.prod(moduli), [0] * (d + 1)
    for prime, residues in rows.collect():
        rest = whole // prime
        unit = rest * pow(rest, -1, prime)
        out = [(c + r * unit) % whole for c, r in zip(out, residues, strict=True)]
    return [c - whole if c > whole // 2 else c for c in out]


def roots_above(coefficients: list[int], a: int) -> int:
    """Number of roots above ``a`` of a polynomial whose roots are all real: the sign changes of p(x + a)."""
    shifted = list(coefficients)
    if a:
        for i in range(len(shifted) - 1):
            for j in range(len(shifted) - 2, i - 1, -1):
                shifted[j] += a * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def largest_roots(coefficients: list[int], count: int, bits: int = BITS) -> tuple[list[int], int]:
    """The ``count`` largest positive roots (as often as they occur), falling, each as the integer below root * 2 ** shift,
    and that shift. All roots must be real and none negative."""
    zeros = next(i for i, c in enumerate(coefficients) if c)
    positive = coefficients[zeros:]
    degree = len(positive) - 1
    if not degree:
        return [], 0
    trace = -positive[-2]  # no root is larger
    shift = max(0, bits - trace.bit_length())
    scaled = [c << shift * (degree - i) for i, c in enumerate(positive)]
    found: list[int] = []
    # Intervals (low, high] with the number of roots above each end, the uppermost last.
    open_intervals = [(0, trace << shift, degree, 0)]
    while open_intervals and len(found) < count:
        low, high, above_low, above_high = open_intervals.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if high - low == 1:
            found += [low] * inside
        elif inside == 1:
            found.append(_refined(scaled, low, high))
        else:
            middle = (low + high) // 2
            above = roots_above(scaled, middle)
            open_intervals += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found[:count], shift


def _refined(coefficients: list[int], low: int, high: int) -> int:
    """The integer below the only root in (low, high], which is simple."""

    def at(x: int) -> int:
        value = 0
        for c in reversed(coefficients):
            value = value * x + c
        return value

    if not at(high):
        return high - 1
    rising = at(high) > 0
    while high - low > 1:
        middle = (low + high) // 2
        value = at(middle)
        if not value:
            return middle - 1
        low, high = (low, middle) if (value > 0) == rising else (middle, high)
    return low


def null_vectors(matrix: Matrix, roots: list[int], shift: int) -> list[list[float]]:
    """Orthonormal eigenvectors for roots (times 2 ** shift) that lie close together, by inverse iteration: solving with
    matrix - root stretches its null space by far more than anything else."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = 2 * BITS * 3 // 10 + 40
        context.Emax, context.Emin = 10**9, -(10**9)
        trace = Decimal(sum(matrix[i][i] for i in range(d)))
        tiny = trace * Decimal(10) ** (20 - context.prec)
        unit, done = Decimal(2) ** shift, []
        for number, root in enumerate(roots):
            mu = (Decimal(root) + Decimal("0.5")) / unit
            upper = [[Decimal(x) - mu if i == j else Decimal(x) for j, x in enumerate(row)] for i, row in enumerate(matrix)]
            steps: list[tuple[int, list[Decimal]]] = []
            for k in range(d):
                best = max(range(k, d), key=lambda i: abs(upper[i][k]))
                upper[k], upper[best] = upper[best], upper[k]
                if abs(upper[k][k]) < tiny:
                    upper[k][k] = tiny
                row, factors = upper[k], []
                for i in range(k + 1, d):
                    factor = upper[i][k] / row[k]
                    factors.append(factor)
                    if factor:
                        below = upper[i]
                        below[k + 1 :] = [x - factor * y for x, y in zip(below[k + 1 :], row[k + 1 :], strict=True)]
                steps.append((best, factors))
            draw = random.Random(number)
            vector = [Decimal(draw.randrange(-(1 << 30), 1 << 30) * 2 + 1) for _ in range(d)]
            for _ in range(3):
                for k, (best, factors) in enumerate(steps):
                    vector[k], vector[best] = vector[best], vector[k]
                    for i, factor in enumerate(factors, k + 1):
                        vector[i] -= factor * vector[k]
                for k in reversed(range(d)):
                    rest = sum((x * y for x, y in zip(upper[k][k + 1 :], vector[k + 1 :], strict=True)), Decimal(0))
                    vector[k] = (vector[k] - rest) / upper[k][k]
                for other in done:
                    along = sum((x * y for x, y in zip(vector, other, strict=True)), Decimal(0))
                    vector = [x - along * y for x, y in zip(vector, other, strict=True)]
                length = sum((x * x for x in vector), Decimal(0)).sqrt()
                vector = [x / length for x in vector]
            done.append(vector)
        return [[float(x) for x in v] for v in done]


def components(spark: SparkSession, matrix: Matrix, count: int = COMPONENTS) -> list[tuple[float, float, list[float]]]:
    """(eigenvalue, its share of the trace, unit eigenvector), falling, for the positive eigenvalues of a scatter matrix."""
    divisor = math.gcd(*(x for row in matrix for x in row)) if matrix else 0
    if not divisor:
        return []
    small = [[x // divisor for x in row] for row in matrix]
    trace = sum(small[i][i] for i in range(len(small)))
    roots, shift = largest_roots(characteristic_polynomial(spark, small), count)
    groups: list[list[int]] = []
    for root in roots:
        if groups and groups[-1][-1] - root <= trace << shift >> CLOSE:
            groups[-1].append(root)
        else:
            groups.append([root])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                found = null_vectors(small, groups[k], shift)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(found), pa.int64()), pa.array(range(len(found)), pa.int64()), pa.array(found)], ["k", "m", "v"])

    tasks = min(len(groups), spark.sparkContext.defaultParallelism)
    rows = arrow_map(spark.range(len(groups)).repartition(tasks), run, "k bigint, m bigint, v array<double>")
    found = {(r.k, r.m): r.v for r in rows.collect()}  # at most `count` vectors
    out = []
    for k, group in enumerate(groups):
        for m, root in enumerate(group):
            value = (2 * root + 1) * divisor
            out.append((float(value / (2 << shift)), (2 * root + 1) / (trace * (2 << shift)), found[k, m]))
    return out


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``, a row per vector and component.

    Vectors that are NULL or hold NULL or non-finite entries (or entries too large for a long after scaling) have no rows,
    nor have those of another length than the commonest. Components are those of the ``count`` largest positive
    eigenvalues: there is none where nothing varies, so an empty table, empty vectors and copies of one vector give an
    empty result. Equal eigenvalues get orthonormal vectors of their common space. Repeated rows and ids, and NULL ids,
    are vectors like any other. ``deviation`` is NULL where the exact sum does not fit a long. Other columns are not
    looked at. ``identity_error`` is measured on the whitened values themselves.
    """
    spark = df.sparkSession
    n, sums, matrix = scatter(df, vector_col)
    found, d = components(spark, matrix, count), len(sums)
    # Rows of n * y - sums are projected, so the factor n of both and the divisor n of the covariance cancel.
    turn = np.asarray([[x / math.sqrt(value) for x in v] for value, _, v in found], np.float64).reshape(len(found), d).T
    explained = np.asarray([share for _, share, _ in found])
    most = max([abs(s) for s in sums], default=0)

    def centred(rows: np.ndarray) -> np.ndarray:
        largest = n * int(np.abs(rows).max(initial=0)) + most
        kind = np.int64 if largest * largest * max(1, d) < 1 << 63 else object
        return rows.astype(kind) * n - np.asarray(sums, kind)

    def chosen(column: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        return next(((places, centred(rows)) for dim, places, rows in by_length(column) if dim == d), None)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(found) + 1, len(found) + 1))
        for batch in batches:
            if (some := chosen(batch.column(1))) is not None:
                white = some[1].astype(np.float64) @ turn
                white = np.hstack([np.ones((len(white), 1)), white])
                total += white.T @ white
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "value"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(found)
        for batch in batches:
            if (some := chosen(batch.column(1))) is None:
                continue
            places, rows = some
            squares = (rows * rows).sum(axis=1)
            if squares.dtype == object:
                squares = [s if s < 1 << 63 else None for s in squares.tolist()]
            white, many = rows.astype(np.float64) @ turn, len(places)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(places, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * k, n, np.int64)), pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(many), k))),
                    pa.array(white.ravel()), pa.array(np.tile(explained, many)), pa.array(np.full(many * k, error)),
                ],
                schema.names,
            )

    ids = df.select(F.col(id_col), F.col(vector_col).alias("__vector"))
    schema = with_columns(T.StructType([ids.schema[0]]), component="int", n="bigint", deviation="bigint", whitened="double", explained="double", identity_error="double")
    if not found:
        return spark.createDataFrame([], schema)
    # Sums of the whitened values, which are centred, and of their products: the rest of a mean (some 1e-13) is taken off.
    sums_of = arrow_map(ids.select(F.lit(0).alias("c"), "__vector"), moments, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    second = np.zeros((len(found) + 1, len(found) + 1))
    for r in sums_of.collect():
        second[r.i, r.j] = second[r.j, r.i] = r.value
    mean = second[0, 1:] / n
    error = float(np.abs(second[1:, 1:] / n - np.outer(mean, mean) - np.eye(len(found))).max())
    return arrow_map(ids, spread, schema)
