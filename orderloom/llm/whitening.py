"""Whiten vectors by components of their exact covariance.

1. Entries become whole numbers, y = floor(1024 * c), and x = y + 100000. One pass sums all products y_i * y_j and all y_i without
   rounding: floats carry sums under 2**53 only, and what tasks hand on are 30-bit limbs that Spark adds up as longs.
2. The scatter matrix C = n * sum(y y') - T T' (T: sums of y) is n**2 times the covariance of x, in whole numbers. Its characteristic
   polynomial is found modulo many 31-bit primes, each prime in a Spark task: Hessenberg reduction, then the recurrence over
   leading blocks. Chinese remaindering gives the whole coefficients; one more prime checks them.
3. All roots are real, so the sign changes of the coefficients, shifted to a place, count the roots above it exactly. Bisection by that
   count isolates the largest roots and the signs of the polynomial narrow each to 2**-192 of the trace.
4. Inverse iteration with 110 digits near each root gives the null space of C - root, a task per root. Roots that even this
   precision can't part are one root of higher multiplicity; its vectors are made orthogonal.
5. A second pass projects every row.

What reaches the driver depends on the number of dimensions only.

Defined results: vectors that are null, empty or hold null or non-finite entries take no part, nor do vectors of another length than the
most frequent one (of equally frequent ones the shorter). A scaled entry beyond +-2**62 counts as +-2**62. Rows with
equal or null ids are rows of their own. Components without variance have no scale, so they are left out; with no rows, or only equal vectors,
there are no result rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.workspace import Workspace

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMIT = 1 << 62
#: Entries under this bound are multiplied as floats: sums over a batch stay under 2**53.
SMALL, BATCH = 1 << 20, 1 << 12
LIMB = 30
DIGITS = 110
#: Roots are known to this many bits below the trace.
ROOT_BITS = 192


# --- whole entries and their products -----------------------------------------------------------

def usable(vectors: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """vec_id and the entries as doubles, of all rows that take part, and their dimension (0: no rows)."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
             .where(F.col("c").isNotNull() & (F.size("c") > 0) & F.forall("c", finite)))
    sizes = sound.groupBy(F.size("c").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return (sound.where(F.size("c") == sizes["d"]), sizes["d"]) if sizes else (sound, 0)


def _entries(column: pa.ListArray, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def whole(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """floor(1024 * c), as floats, and which rows have only small ones; a float of any size is a whole number exactly."""
    with np.errstate(over="ignore"):
        y = np.clip(np.floor(entries * SCALE), -float(LIMIT), float(LIMIT))
    return y, (np.abs(y) < SMALL).all(axis=1)


def _ints(y: np.ndarray) -> np.ndarray:
    """Python's whole numbers, for rows with large entries."""
    return np.array([[int(v) for v in row] for row in y], object).reshape(y.shape)


def _limbs(value: int):
    sign, value, k = (-1, -value, 0) if value < 0 else (1, value, 0)
    while value:
        yield k, sign * (value & ((1 << LIMB) - 1))
        value >>= LIMB
        k += 1


PRODUCTS = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
                         T.StructField("limb", T.IntegerType()), T.StructField("v", T.LongType())])


def products(rows: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums of y, and sums of all products of two entries, exact."""
    def partial(batches):
        total = np.zeros((dim + 1, dim + 1), object)
        for batch in batches:
            y, small = whole(_entries(batch.column(0), dim))
            one = np.ones((len(y), 1))
            y = np.concatenate((y, one), axis=1)  # a last entry of 1 turns sums and the count into products
            few = y[small]
            for a in range(0, len(few), BATCH):
                part = few[a:a + BATCH]
                total += (part.T @ part).astype(np.int64).astype(object)
            for a in range(0, len(large := y[~small]), 64):
                part = _ints(large[a:a + 64])
                total += part.T.dot(part)
        found = [(i, j, k, v) for i in range(dim + 1) for j in range(i, dim + 1) for k, v in _limbs(int(total[i, j]))]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(found, columns=PRODUCTS.names).astype(
            {"i": "int32", "j": "int32", "limb": "int32", "v": "int64"}), preserve_index=False)

    sums = np.zeros((dim + 1, dim + 1), object)
    for r in rows.select("c").mapInArrow(partial, PRODUCTS).groupBy("i", "j", "limb").agg(F.sum("v").alias("v")).collect():
        sums[r["i"], r["j"]] += r["v"] << (LIMB * r["limb"])
    gram = [[int(sums[min(i, j), max(i, j)]) for j in range(dim)] for i in range(dim)]
    return int(sums[dim, dim]), [int(sums[i, dim]) for i in range(dim)], gram


def scatter(n: int, sums: list[int], gram: list[list[int]]) -> list[list[int]]:
    """n**2 times the covariance, in whole numbers; a shift of all entries doesn't change it."""
    return [[n * g - a * b for g, b in zip(row, sums)] for row, a in zip(gram, sums)]


# --- the characteristic polynomial ---------------------------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number under 3 * 10**9."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_below(start: int, product: int) -> list[int]:
    """Odd primes below ``start``, largest first, whose product exceeds ``product``, and one more."""
    found, reached, n = [], 1, start - 1 - start % 2
    while reached <= product:
        if is_prime(n):
            found.append(n)
            reached *= n
        n -= 2
    while not is_prime(n):
        n -= 2
    return [*found, n]


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """det(x - matrix) modulo the prime ``p`` (under 2**31), lowest coefficient first."""
    a = np.array([[v % p for v in row] for row in matrix], np.int64)
    n = len(a)
    for k in range(n - 2):
        below = np.flatnonzero(a[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factors = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - factors[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * factors % p).sum(axis=1)) % p
    leading = [np.zeros(n + 1, np.int64)]
    leading[0][0] = 1
    for k in range(n):
        now = np.roll(leading[k], 1)
        now = (now - int(a[k, k]) * leading[k]) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(a[i + 1, i]) % p
            if not below:
                break
            now = (now - int(a[i, k]) * below % p * leading[i]) % p
        leading.append(now)
    return [int(c) for c in leading[n]]


def coefficient_bound(trace: int, dim: int) -> int:
    """Of a matrix without negative eigenvalues: sums of products of k of them are largest if all are equal."""
    return max(math.comb(dim, k) * (trace // dim + 1) ** k for k in range(dim + 1))


RESIDUES = T.StructType([T.StructField("p", T.LongType()), T.StructField("c", T.ArrayType(T.LongType()))])


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Whole coefficients of det(x - matrix), lowest first; ``matrix`` has no negative eigenvalue."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    primes = primes_below(1 << 31, 2 * coefficient_bound(trace, len(matrix)))

    def residues(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"p": [p], "c": [polynomial_modulo(matrix, p)]},
                                                 schema=pa.schema([("p", pa.int64()), ("c", pa.list_(pa.int64()))]))

    tasks = min(len(primes), max(8, spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    found = {r["p"]: r["c"] for r in listed.mapInArrow(residues, RESIDUES).collect()}
    *used, check = primes
    modulus = math.prod(used)
    out = [0] * (len(matrix) + 1)
    for p in used:
        rest = modulus // p
        unit = rest * pow(rest, -1, p)
        out = [c + unit * r for c, r in zip(out, found[p])]
    out = [(c + modulus // 2) % modulus - modulus // 2 for c in out]  # of either sign
    if [c % check for c in out] != found[check]:
        raise ArithmeticError("the polynomial's coefficients exceed their bound")
    return out


# --- its largest roots -------------------------------------------------------------------------------

def roots_above(poly: list[int], at: int) -> int:
    """How many roots are greater than ``at``, each as often as it counts, of a polynomial with real roots only."""
    c = list(poly)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], at: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * at + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], top: int, bits: int = ROOT_BITS) -> tuple[list[tuple[int, int]], int]:
    """Positive roots, largest first, as (place, how often), until ``top`` are found, and the scale: a root is within
    one of place / 2**scale."""
    degree, trace = len(poly) - 1, -poly[-2]
    scale = max(0, bits - trace.bit_length())
    poly = [c << scale * (degree - k) for k, c in enumerate(poly)]
    found: list[tuple[int, int]] = []
    high = (trace << scale) + 1
    open_: list[tuple[int, int, int, int]] = [(0, high, roots_above(poly, 0), 0)]  # low, high, roots above low and above high
    while open_ and sum(n for _, n in found) < top:
        low, high, over_low, over_high = open_.pop()
        n = over_low - over_high
        if not n:
            continue
        if n == 1:
            last = _sign(poly, high)
            while high - low > 1 and last:
                mid = (low + high) // 2
                sign = _sign(poly, mid)
                low, high, last = (mid, high, last) if sign == -last else (low, mid, sign)
        if n == 1 or high - low == 1:
            found.append((high, n))
            continue
        mid = (low + high) // 2
        over_mid = roots_above(poly, mid)
        open_ += [(low, mid, over_low, over_mid), (mid, high, over_mid, over_high)]
    return found, scale


# --- components ----------------------------------------------------------------------------------------

def null_vectors(matrix: list[list[int]], place: int, scale: int, count: int) -> np.ndarray:
    """``count`` orthogonal unit vectors that ``matrix`` only stretches by place / 2**scale, as floats."""
    n = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        root = Decimal(place) / Decimal(1 << scale)
        size = root + 1
        a = np.array([[Decimal(v) for v in row] for row in matrix], object).reshape(n, n)
        a[range(n), range(n)] -= root
        order = np.arange(n)
        for k in range(n):
            best = k + max(range(n - k), key=lambda i: abs(a[k + i, k]))
            if best != k:
                a[[k, best]] = a[[best, k]]
                order[[k, best]] = order[[best, k]]
            if abs(a[k, k]) < size.scaleb(20 - DIGITS):
                a[k, k] = size.scaleb(20 - DIGITS)  # the null space itself
            if k + 1 < n:
                a[k + 1:, k] /= a[k, k]
                a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])

        def solve(b):
            x = b[order].copy()
            for i in range(1, n):
                x[i] -= a[i, :i].dot(x[:i])
            for i in range(n - 1, -1, -1):
                x[i] = (x[i] - (a[i, i + 1:].dot(x[i + 1:]) if i + 1 < n else 0)) / a[i, i]
            return x

        found: list[np.ndarray] = []
        for m in range(count):
            rule = np.random.default_rng(m)
            x = np.array([Decimal(int(v)) for v in rule.integers(1, 1 << 20, n)], object)
            for _ in range(3):
                x = solve(x)
                for _ in range(2):
                    for other in found:
                        x = x - other * other.dot(x)
                    x = x / x.dot(x).sqrt()
            found.append(x * (1 if max(x, key=abs) > 0 else -1))
        return np.array([[float(v) for v in x] for x in found])


SPACES = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("v", T.ArrayType(T.ArrayType(T.DoubleType())))])


def components(spark: SparkSession, matrix: list[list[int]], top: int = COMPONENTS) -> tuple[np.ndarray, list[Decimal]]:
    """Unit eigenvectors of the ``top`` largest positive eigenvalues of ``matrix``, as rows, and the eigenvalues."""
    found, scale = largest_roots(characteristic_polynomial(spark, matrix), top)

    def spaces(batches):
        for batch in batches:
            for at in batch.column(0).to_pylist():
                v = null_vectors(matrix, found[at][0], scale, found[at][1])
                yield pa.RecordBatch.from_pydict({"at": [at], "v": [v.tolist()]}, schema=pa.schema(
                    [("at", pa.int32()), ("v", pa.list_(pa.list_(pa.float64())))]))

    if not found:
        return np.zeros((0, len(matrix))), []
    listed = spark.createDataFrame([(i,) for i in range(len(found))], "at int").repartition(len(found))
    made = dict((r["at"], r["v"]) for r in listed.mapInArrow(spaces, SPACES).collect())
    with localcontext() as context:
        context.prec = DIGITS
        values = [Decimal(place) / Decimal(1 << scale) for place, n in found for _ in range(n)]
    return np.array([v for i in range(len(found)) for v in made[i]])[:top], values[:top]


# --- rows --------------------------------------------------------------------------------------------------

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("deviation", T.LongType()),
                     T.StructField("deviation_digits", T.StringType()), T.StructField("w", T.ArrayType(T.DoubleType()))])


def _squares(z: np.ndarray) -> list[int]:
    """Exact sums of squares of rows of whole floats under 2**52."""
    low = np.mod(z, float(1 << 26)).astype(np.int64)
    high = ((z - low) / (1 << 26)).astype(np.int64)
    parts = ((high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))
    return [(int(a) << 52) + (int(b) << 27) + int(c) for a, b, c in zip(*parts)]


def _projected(rows: DataFrame, dim: int, n: int, sums: list[int], vectors: np.ndarray, values: list[Decimal]) -> DataFrame:
    """vec_id, deviation, and the whitened values: (x - mean) on a component over its deviation, where n cancels out."""
    roots = np.sqrt(np.array([float(v) for v in values]))
    plain = n * SMALL + max(abs(s) for s in sums) < 1 << 52 and dim <= 1024  # sums of squares of halves fit 64 bits

    def project(batches):
        total_f, total_i = np.array([float(s) for s in sums]), np.array(sums, object)
        for batch in batches:
            y, small = whole(_entries(batch.column(1), dim))
            fast = small & plain
            z = y * float(n) - total_f  # exact where fast
            deviation = np.empty(len(y), object)
            if fast.any():
                deviation[fast] = _squares(z[fast])
            for i in np.flatnonzero(~fast):
                exact = n * _ints(y[i:i + 1])[0] - total_i
                deviation[i] = int((exact * exact).sum())
                z[i] = [float(v) for v in exact]
            w = (z @ vectors.T) / roots
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64()),
                pa.array([str(d) for d in deviation], pa.string()), pa.array(list(w), pa.list_(pa.float64()))], names=ROWS.names)

    return rows.select("vec_id", "c").mapInArrow(project, ROWS)


def identity_error(rows: DataFrame, n: int, top: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity; values are centred before they are multiplied."""
    w = [F.col("w")[k] for k in range(top)]
    means = rows.agg(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(w)]).first()
    pairs = [(i, j) for i in range(top) for j in range(i, top)]
    sums = rows.agg(*[F.sum((w[i] - means[i]) * (w[j] - means[j])).alias(f"s{i}_{j}") for i, j in pairs]).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(sums, pairs))


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", top: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, deviation_digits.

    ``deviation`` is null where it exceeds 64 bits; ``deviation_digits`` has it in any case.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark, "whitening")
    rows, dim = usable(vectors, vec_id, vector)
    rows = ws.store(rows, "vectors")
    n, sums, gram = products(rows, dim) if dim else (0, [], [])
    matrix = scatter(n, sums, gram)
    trace = sum(matrix[i][i] for i in range(dim))
    found, values = components(spark, matrix, top) if trace else (np.zeros((0, dim)), [])
    if not values:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                                         "identity_error double, deviation_digits string")
    made = ws.store(_projected(rows, dim, n, sums, found, values), "whitened")
    ws.drop(rows)
    error = identity_error(made, n, len(values))
    shares = F.array(*[F.lit(float(v / trace)) for v in values])
    return (made.select("vec_id", "deviation", "deviation_digits", F.posexplode("w").alias("_at", "whitened"))
            .select("vec_id", (F.col("_at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(shares, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"), "deviation_digits"))
