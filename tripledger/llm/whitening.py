"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Entries become whole numbers, `floor(64 c) + 1000000`. Over the distinct vectors Spark sums
products of entries exactly, in tasks and then by place in the matrix. The scatter
`n * sum(x x') - S S'`, n^2 times the covariance, is a matrix of whole numbers; so its
characteristic polynomial has whole coefficients, which tasks compute modulo many primes by
reduction to Hessenberg form and the Chinese remainder theorem puts together. All roots are real:
Descartes' count of sign changes, after a shift, tells exactly how many roots lie above a point,
which isolates the greatest ones; bisection on exact signs narrows them to 2^-110 of their size. A
component is the null space of the scatter minus its root, by inverse iteration in long decimals.
Roots that agree to 2^-60 share one space, of which an orthonormal basis is taken.

Rows whose vector is null, is empty, or holds null, NaN or infinite entries are dropped; so are
vectors of another length than the one that most distinct vectors have (the greater, if equal).
Entries beyond 2^56 count as 2^56, by sign. Repeated vectors count once in the fit, and every row
is transformed. Components with eigenvalue zero are not given: one distinct vector, or none, has
no component and gives no rows. Vectors with equal ids are rows of their own. All input columns
ride along in one struct `row` and cannot clash with the columns added.

The matrix and its polynomial grow with the length of the vectors only, not with their number.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.common import packed
from tripledger.sources.scratch import materialize

SCALE, OFFSET = 64, 1_000_000
#: Entries are kept below this, so that they fit 64 bits with room to spare.
LARGEST = 1 << 62
#: Bits of the pieces in which products are multiplied (exact in doubles for `ROWS` rows) and summed.
PIECE, LIMB = 20, 30
ROWS = 1 << 12
#: Relative width at which roots count as one, and to which single roots are narrowed.
SAME, FINE = Fraction(1, 1 << 60), Fraction(1, 1 << 110)
#: Decimal digits of the inverse iteration, and its rounds.
DIGITS, ROUNDS = 110, 3
#: Primes a task works on together.
PRIMES = 32


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Valid rows of each length: their places in the batch, and entries less `OFFSET`."""
    column = column.cast(pa.large_list(pa.float64()))
    ends, values = column.offsets.to_numpy(), column.values
    entries = values.to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        bad = np.r_[0, np.cumsum(~np.isfinite(entries) | values.is_null().to_numpy(zero_copy_only=False))]
        sizes = np.diff(ends)
        good = (bad[ends[1:]] == bad[ends[:-1]]) & (sizes > 0) & column.is_valid().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes[good]):
            rows = np.flatnonzero(good & (sizes == size))
            found = entries[ends[rows][:, None] + np.arange(size)]
            whole = np.floor(np.clip(found * SCALE, -float(LARGEST), float(LARGEST)))
            yield rows, whole.astype(np.int64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector as bytes: the width of its entries, then the entries; equal vectors, equal bytes."""
    for batch in batches:
        for _, x in _vectors(batch.column(0)):
            high = np.abs(x).max(axis=1)
            for width, low, top in ((2, -1, 1 << 15), (4, 1 << 15, 1 << 31), (8, 1 << 31, LARGEST + 1)):
                rows = x[(high >= low) & (high < top)]
                if len(rows):
                    raw = np.empty((len(rows), 1 + width * x.shape[1]), np.uint8)
                    raw[:, 0] = width
                    raw[:, 1:] = rows.astype(f"<i{width}").view(np.uint8).reshape(len(rows), -1)
                    ends = pa.array(np.arange(len(rows) + 1) * raw.shape[1], pa.int64())
                    out = pa.Array.from_buffers(pa.large_binary(), len(rows),
                                                [None, ends.buffers()[1], pa.py_buffer(raw.tobytes())])
                    yield pa.RecordBatch.from_arrays([out.cast(pa.binary())], ["x"])


def _unpack(column: pa.Array) -> Iterator[np.ndarray]:
    groups: dict[tuple[int, int], list[bytes]] = {}
    for raw in column.to_pylist():
        groups.setdefault((raw[0], len(raw)), []).append(raw)
    for (width, size), rows in groups.items():
        flat = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), size)
        yield np.ascontiguousarray(flat[:, 1:]).view(f"<i{width}").astype(np.int64)


def products(x: np.ndarray) -> np.ndarray:
    """`x' x` in whole numbers of any size, with pieces small enough for exact doubles."""
    pieces = []
    left = x
    while True:
        piece = (left + (1 << PIECE - 1) & (1 << PIECE) - 1) - (1 << PIECE - 1)
        pieces.append(piece.astype(np.float64))
        left = left - piece >> PIECE
        if not left.any():
            break
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for i, a in enumerate(pieces):
        for j, b in enumerate(pieces):
            total += (a.T @ b).astype(np.int64).astype(object) * (1 << PIECE * (i + j))
    return total


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's number of vectors, sums and sums of products, in limbs by place."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for whole in _unpack(batch.column(0)):
            for at in range(0, len(whole), ROWS):
                x = whole[at:at + ROWS]
                part = products(np.c_[np.ones(len(x), np.int64), x])
                size = x.shape[1]
                totals[size] = totals[size] + part if size in totals else part
    for size, total in totals.items():
        i, j = np.triu_indices(size + 1)
        left, limb = total[i, j], 0
        while any(left):
            value = np.array([v & (1 << LIMB) - 1 for v in left], np.int64)
            if limb * LIMB > 4096:
                raise OverflowError("sums beyond all bounds")
            left = np.array([v >> LIMB for v in left], object)
            if all(v == -1 for v in left[left != 0]) and (left != 0).any():
                # The last limb carries the sign.
                value, left = value + np.where(left == -1, -(1 << LIMB), 0), np.zeros(len(left), object)
            yield pa.RecordBatch.from_pydict({
                "size": np.full(len(i), size, np.int32), "i": i.astype(np.int32), "j": j.astype(np.int32),
                "limb": np.full(len(i), limb, np.int32), "value": value.astype(np.int64)})
            limb += 1


def scatter(df: DataFrame, column: str) -> tuple[int, list[int], list[list[int]]]:
    """Number of distinct vectors, their sums less n times `OFFSET`, and the scatter matrix."""
    distinct = df.select(F.col(f"`{column}`").alias("v")).mapInArrow(_pack, "x binary").distinct()
    sums = distinct.mapInArrow(_sums, "size int, i int, j int, limb int, value long")
    sums = materialize(sums.groupBy("size", "i", "j", "limb").agg(F.sum("value").alias("value")), "scatter")
    counts = sums.where("i = 0 AND j = 0").groupBy("size").agg(
        F.sum(F.col("value") * F.pow(F.lit(2.0), F.col("limb") * LIMB)).alias("n"))
    most = counts.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return 0, [], []
    d = most["size"]
    q = [[0] * (d + 1) for _ in range(d + 1)]
    for r in sums.where(F.col("size") == d).collect():  # (d + 1)(d + 2) / 2 places
        q[r["i"]][r["j"]] += r["value"] << LIMB * r["limb"]
    n, s = q[0][0], q[0][1:]
    m = [[n * q[min(i, j)][max(i, j)] - s[i - 1] * s[j - 1] for j in range(1, d + 1)] for i in range(1, d + 1)]
    return n, s, m


def primes_below(top: int, count: int) -> list[int]:
    """The `count` greatest primes below `top` (at most 2^32), by a sieve in stretches."""
    found, at, width = [], top, 1 << 15
    small = np.ones(1 << 16, bool)
    small[:2] = False
    for p in range(2, 1 << 8):
        if small[p]:
            small[p * p::p] = False
    divisors = np.flatnonzero(small)
    while len(found) < count:
        low = at - width
        open_ = np.ones(width, bool)
        for p in divisors.tolist():
            open_[-low % p::p] = False
        found += [low + int(i) for i in np.flatnonzero(open_)[::-1]]
        at = low
    return found[:count]


def _power(base: np.ndarray, exponent: np.ndarray, p: np.ndarray) -> np.ndarray:
    out, base, exponent = np.ones_like(base), base.copy(), exponent.copy()
    while exponent.any():
        out = np.where(exponent & 1, out * base % p, out)
        base, exponent = base * base % p, exponent >> 1
    return out


def polynomials(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Characteristic polynomials modulo each prime below 2^31: coefficients, constant first."""
    d, p = len(matrix), np.array(primes, np.int64)
    h = np.array([[[v % q for v in row] for row in matrix] for q in primes], np.int64)
    p1, p2, every = p[:, None], p[:, None, None], np.arange(len(primes))
    for m in range(1, d - 1):
        pivot = m + (h[:, m:, m - 1] != 0).argmax(axis=1)
        row = h[every, pivot].copy()
        h[every, pivot], h[:, m] = h[:, m].copy(), row
        column = h[every, :, pivot].copy()
        h[every, :, pivot], h[:, :, m] = h[:, :, m].copy(), column
        inverse = _power(h[:, m, m - 1], p - 2, p)  # zero, where the column is zero already
        u = h[:, m + 1:, m - 1] * inverse[:, None] % p1
        h[:, m + 1:] = (h[:, m + 1:] - u[:, :, None] * h[:, None, m] % p2) % p2
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1:] * u[:, None, :] % p2).sum(axis=2)) % p1
    out = np.zeros((d + 1, len(primes), d + 1), np.int64)
    out[0, :, 0] = 1
    for k in range(1, d + 1):
        now = np.zeros((len(primes), d + 1), np.int64)
        now[:, 1:] = out[k - 1, :, :-1]
        below = np.ones(len(primes), np.int64)
        for i in range(k - 1, -1, -1):
            if i < k - 1:
                below = below * h[:, i + 1, i] % p
            now = (now - (h[:, i, k - 1] * below % p)[:, None] * out[i] % p1) % p1
        out[k] = now
    return out[d]


def symmetric_sums(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Elementary symmetric sums of the eigenvalues of a positive semidefinite matrix of whole numbers."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # By Maclaurin's inequality no sum exceeds that of equal eigenvalues.
    bound = max(comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    primes = primes_below(1 << 31, bound.bit_length() // 30 + 2)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("p").to_pylist()
            for at in range(0, len(own), PRIMES):
                part = own[at:at + PRIMES]
                yield pa.RecordBatch.from_pydict({"p": part, "c": polynomials(matrix, part).tolist()})

    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(-(-len(primes) // PRIMES))
    found = {r["p"]: r["c"] for r in dealt.mapInArrow(reduce, "p long, c array<long>").collect()}  # primes x d
    product = 1
    for p in primes:
        product *= p
    weights = [(product // p) * pow(product // p, -1, p) for p in primes]
    sums = []
    for k in range(d + 1):
        value = sum(w * found[p][d - k] for w, p in zip(weights, primes)) % product
        sums.append(value if k % 2 == 0 else -value % product)
    if sums[0] != 1 or (d and sums[1] != trace):
        raise ArithmeticError("residues do not fit together")
    return sums


class RealRoots:
    """Roots of a polynomial all of whose roots are real and positive, from its symmetric sums."""

    def __init__(self, sums: list[int]):
        while len(sums) > 1 and not sums[-1]:
            sums = sums[:-1]
        self.degree = len(sums) - 1
        self.falling = [-s if k % 2 else s for k, s in enumerate(sums)]

    def _scaled(self, t: Fraction) -> tuple[list[int], int]:
        q = t.denominator
        return [c * q ** k for k, c in enumerate(self.falling)], t.numerator

    def sign(self, t: Fraction) -> int:
        coefficients, a = self._scaled(t)
        value = 0
        for c in coefficients:
            value = value * a + c
        return (value > 0) - (value < 0)

    def above(self, t: Fraction) -> int:
        """How many roots exceed `t`, each as often as it occurs."""
        c, a = self._scaled(t)
        for last in range(self.degree, 0, -1):
            for i in range(1, last + 1):
                c[i] += a * c[i - 1]
        signs = [v > 0 for v in c if v]
        return sum(x != y for x, y in zip(signs, signs[1:]))

    def greatest(self, count: int, top: int) -> list[tuple[Fraction, int]]:
        """The `count` greatest roots, none above `top`, with how often each occurs; more of the last, if equal."""
        found, taken = [], 0
        stack = [(Fraction(0), Fraction(top), self.degree, 0)]
        while stack and taken < count:
            low, high, above_low, above_high = stack.pop()
            inside = above_low - above_high
            if not inside:
                continue
            if inside == 1 or high - low <= low * SAME:
                root = self._narrow(low, high) if inside == 1 else (low + high) / 2
                found.append((root, inside))
                taken += inside
                continue
            middle = (low + high) / 2
            above = self.above(middle)
            stack += [(low, middle, above_low, above), (middle, high, above, above_high)]
        return found

    def _narrow(self, low: Fraction, high: Fraction) -> Fraction:
        """The single root in (low, high]."""
        side = self.sign(high)
        if not side:
            return high
        while high - low > low * FINE:
            middle = (low + high) / 2
            here = self.sign(middle)
            if not here:
                return middle
            low, high = (low, middle) if here == side else (middle, high)
        return (low + high) / 2


def _decimal(value: Fraction) -> Decimal:
    return Decimal(value.numerator) / Decimal(value.denominator)


def null_space(matrix: list[list[int]], root: Fraction, count: int) -> list[list[Decimal]]:
    """`count` orthonormal vectors of the matrix's eigenspace for a root, to some `DIGITS` / 2 digits."""
    with decimal.localcontext(prec=DIGITS):
        d, mu = len(matrix), _decimal(root)
        a = [[Decimal(v) - mu if i == j else Decimal(v) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        least = max(abs(v) for row in a for v in row).scaleb(-DIGITS)
        order = list(range(d))
        for k in range(d):
            pivot = max(range(k, d), key=lambda i: abs(a[i][k]))
            a[k], a[pivot], order[k], order[pivot] = a[pivot], a[k], order[pivot], order[k]
            top = a[k]
            if abs(top[k]) < least:
                top[k] = least
            for i in range(k + 1, d):
                row = a[i]
                if row[k]:
                    row[k] = f = row[k] / top[k]
                    row[k + 1:] = [x - f * y for x, y in zip(row[k + 1:], top[k + 1:])]

        def solve(b: list[Decimal]) -> list[Decimal]:
            y = [b[i] for i in order]
            for i in range(d):
                y[i] -= sum(x * z for x, z in zip(a[i][:i], y))
            for i in range(d - 1, -1, -1):
                y[i] = (y[i] - sum(x * z for x, z in zip(a[i][i + 1:], y[i + 1:]))) / a[i][i]
            return y

        # Any start serves that is not orthogonal to the space; these are fixed, so results repeat.
        basis = [[Decimal((7919 * (i + 1) * (c + 1)) % 10007 + 1) for i in range(d)] for c in range(count)]
        for _ in range(ROUNDS):
            for c in range(count):
                v = solve(basis[c])
                for _again in range(2):
                    for w in basis[:c]:
                        f = sum(x * y for x, y in zip(v, w))
                        v = [x - f * y for x, y in zip(v, w)]
                    size = sum(x * x for x in v).sqrt()
                    v = [x / size for x in v]
                basis[c] = v
        for c, v in enumerate(basis):
            if max(v, key=abs) < 0:
                basis[c] = [-x for x in v]
        return basis


@dataclass(frozen=True)
class Whitening:
    """What `transform` needs: all of it bounded by the length of the vectors."""

    n: int
    sums: list[int]  # of the entries less OFFSET
    weights: np.ndarray  # length x components: component entries over the root of the eigenvalue
    components: np.ndarray
    eigenvalues: list[float]
    explained: list[float]
    identity_error: float


def fit(df: DataFrame, column: str, components: int = 16) -> Whitening | None:
    """The whitening of the distinct vectors in `column`; None if it has no component."""
    spark = df.sparkSession
    n, s, m = scatter(df, column)
    trace = sum(m[i][i] for i in range(len(m)))
    if not trace:
        return None
    roots = RealRoots(symmetric_sums(spark, m)).greatest(components, trace)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("i").to_pylist():
                space = null_space(m, *roots[i])
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "v": [[[str(x) for x in v] for v in space]]})

    dealt = spark.createDataFrame([(i,) for i in range(len(roots))], "i int").repartition(len(roots), "i")
    spaces = {r["i"]: r["v"] for r in dealt.mapInArrow(vectors, "i int, v array<array<string>>").collect()}
    pairs = [(root, v) for i, (root, _) in enumerate(roots) for v in spaces[i]][:components]
    with decimal.localcontext(prec=DIGITS):
        unit = [[Decimal(x) for x in v] for _, v in pairs]
        e = [_decimal(root) / n / n for root, _ in pairs]
        weights = np.array([[float(x / value.sqrt()) for x in v] for v, value in zip(unit, e)]).T
        # The covariance of the doubles above, once more in long decimals.
        w = [[Decimal(float(x)) for x in column] for column in weights.T]
        mw = [[sum(x * y for x, y in zip(row, v)) for row in m] for v in w]
        error = max(abs(sum(x * y for x, y in zip(v, u)) / n / n - (i == j))
                    for i, v in enumerate(w) for j, u in enumerate(mw))
        return Whitening(
            n, s, weights, np.array([[float(x) for x in v] for v in unit]), [float(x) for x in e],
            [float(root / trace) for root, _ in pairs], float(error))


def transform(df: DataFrame, column: str, model: Whitening) -> DataFrame:
    """`row`, `deviation` decimal(38, 0) (null beyond that), `whitened` array of doubles; dropped rows are gone."""
    n, sums, weights = model.n, np.array(model.sums, object), model.weights
    small = max(map(abs, model.sums)) < 1 << 62
    kind = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, x in _vectors(batch.column("v")):
                if x.shape[1] != len(sums):
                    continue
                largest = n * int(np.abs(x).max()) + max(map(abs, model.sums))
                if small and largest * largest * len(sums) < 1 << 63:
                    off = n * x - sums.astype(np.int64)
                    deviation = pa.array((off * off).sum(axis=1)).cast(kind)
                else:
                    off = n * x.astype(object) - sums
                    exact = (off * off).sum(axis=1)
                    deviation = pa.array([Decimal(v) if v < 10 ** 38 else None for v in exact], kind)
                projected = off.astype(np.float64) / n @ weights
                ends = pa.array(np.arange(len(x) + 1) * weights.shape[1], pa.int32())
                white = pa.ListArray.from_arrays(ends, pa.array(projected.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(places)), deviation, white], ["row", "deviation", "whitened"])

    whole = packed(df, v=F.col(f"`{column}`"))
    schema = whole.select("row", F.lit(None).cast("decimal(38,0)").alias("deviation"),
                          F.lit(None).cast("array<double>").alias("whitened")).schema
    return whole.mapInArrow(run, schema)
