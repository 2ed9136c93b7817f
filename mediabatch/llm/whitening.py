"""Whitening of embeddings by spectrum slicing.

Each entry c becomes the whole number floor(64 * c) + 1,000,000. Sums are taken first; then every vector is centred on the
sums' whole quotient, so that products are small whole numbers whose sums are exact, and the remainders' part is taken
off exactly: the covariance is rounded once. Its leading eigenvalues are isolated by inertia: the signs of the pivots
of an LDL' factorisation (Bunch-Kaufman) of V - s I count the eigenvalues above s, and shifts are halved until each
wanted number has an interval of its own. From there Rayleigh quotient iteration converges cubically, and two more counts
on either side certify that the pair found has that number. Eigenvalues too close to be told apart are a cluster: its vectors
are found one after another, orthogonal to each other, and certified together.

Tasks send one matrix each, in rows; rows are added in `SLOTS` groups and then once more, so no task adds up more than
a share of them. The covariance, which has the size of a vector squared whatever the table's, is factorised by the driver.

Defined cases: vectors that are null, hold null or non-finite entries or entries whose whole number has more than 61 bits take no
part; neither do those of another length than most (of equally frequent lengths, the longer); repeated rows and null ids are
vectors of their own; components with no variance beyond rounding are left out, so a single or constant vector has none;
a deviation too large for a long is null; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
BITS = 61
SLOTS = 64
BATCH = 4096
EPS = np.finfo(np.float64).eps


def inertia(matrix: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of `matrix` above `shift`: positive pivots of LDL' with Bunch-Kaufman pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    least = EPS * max(np.abs(a).max(initial=0.0), np.finfo(np.float64).tiny)
    alpha = (1 + 17**0.5) / 8
    above, k, n = 0, 0, len(a)

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j], k:] = a[[j, i], k:]
            a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        largest = abs(a[r, k]) if r > k else 0.0
        width = 1
        if abs(a[k, k]) < alpha * largest:
            row = np.abs(a[r, k:])
            row[r - k] = 0.0
            other = row.max()
            if abs(a[k, k]) * other < alpha * largest**2:
                if abs(a[r, r]) >= alpha * other:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    width = 2
        if width == 1:
            pivot = a[k, k]
            if abs(pivot) < least:  # the shift is an eigenvalue, as far as can be told: it counts as not above
                pivot = -least
            above += pivot > 0
            left = a[k + 1 :, k]
            a[k + 1 :, k + 1 :] -= np.outer(left / pivot, left)
        else:
            above += 1  # such a block has one eigenvalue of each sign
            block, left = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= left @ np.linalg.solve(block, left.T)
        k += width
    return above


def rayleigh(matrix: np.ndarray, start: float, found: list[np.ndarray], seed: int, turns: int = 40) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration orthogonal to `found`, after two steps of inverse iteration at `start`."""
    n = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    basis = np.array(found).reshape(-1, n)

    def unit(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - basis.T @ (basis @ v)
        return v / np.linalg.norm(v)

    v = unit(np.random.default_rng(seed).standard_normal(n))
    value, best = start, (np.inf, start, v)
    for turn in range(turns):
        if turn >= 2:
            value = float(v @ matrix @ v)
        try:
            w = np.linalg.solve(matrix - value * np.eye(n), v)
        except np.linalg.LinAlgError:
            w = np.linalg.solve(matrix - (value + EPS * scale) * np.eye(n), v)
        if not np.isfinite(w).all():
            break
        v = unit(w / np.linalg.norm(w))
        own = float(v @ matrix @ v)
        residual = float(np.linalg.norm(matrix @ v - own * v))
        if turn >= 2 and residual >= best[0] / 2:
            break
        if residual < best[0]:
            best = (residual, own, v)
        if residual <= EPS * scale:
            break
    return best[1], best[2]


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows.

    Eigenvalues that rounding does not tell from nought are left out.
    """
    n = len(matrix)
    radius = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not radius:
        return np.zeros(0), np.zeros((0, n))
    close = 64 * n * EPS * radius
    low, high = close, radius * (1 + 1e-12)
    counts = {high: 0, low: inertia(matrix, low)}
    wanted = min(wanted, counts[low])

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(matrix, shift)
        return counts[shift]

    def interval(number: int) -> tuple[float, float]:
        """Shifts with at least, and fewer than, `number` eigenvalues above them: the tightest known."""
        return max(s for s, c in counts.items() if c >= number), min(s for s, c in counts.items() if c < number)

    values: list[float] = []
    vectors: list[np.ndarray] = []
    while len(values) < wanted:
        number = len(values) + 1
        below, above = interval(number)
        while counts[below] > number and above - below > close:
            count((below + above) / 2)
            below, above = interval(number)
        size = counts[below] - number + 1
        if size == 1:
            # Alone in its interval: iterate, and halve the interval where the iteration strays from it.
            for seed in range(200):
                value, vector = rayleigh(matrix, (below + above) / 2, vectors, seed)
                if count(value + close) == number - 1 and count(value - close) >= number:
                    break
                below, above = interval(number)
                if above - below > close:
                    count((below + above) / 2)
                    below, above = interval(number)
            else:
                raise ArithmeticError(f"eigenvalue {number} was not certified")
            values.append(value)
            vectors.append(vector)
        else:
            pairs = []
            for seed in range(size):
                pairs.append(rayleigh(matrix, (below + above) / 2, vectors + [v for _, v in pairs], seed))
            pairs.sort(key=lambda p: -p[0])
            if count(pairs[0][0] + 2 * close) >= number or count(pairs[-1][0] - 2 * close) < number + size - 1:
                raise ArithmeticError(f"eigenvalues from {number} on were not certified")
            values += [v for v, _ in pairs]
            vectors += [v for _, v in pairs]
    return np.array(values[:wanted]), np.array(vectors[:wanted]).reshape(-1, n)


def usable(embeddings: DataFrame, id_column: str, column: str) -> tuple[DataFrame, int, int]:
    """(vec_id, v) of the vectors that take part, entries as doubles and all of one length; their number, and the greatest
    distance of two of their whole numbers."""
    vector = F.col(column).cast("array<double>")
    fits = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < 2.0**BITS / SCALE))  # false for infinity and NaN alike
    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("v")).filter(
        F.col("v").isNotNull() & fits & (F.size("v") > 0)
    )
    kinds = rows.groupBy(F.size("v").alias("size")).agg(
        F.count("*").alias("n"), F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")
    )
    most = kinds.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return rows, 0, 0
    span = int(np.floor(SCALE * most["high"])) - int(np.floor(SCALE * most["low"])) + 1
    return rows.filter(F.size("v") == most["size"]), most["n"], span


def whole_numbers(batch: pd.Series) -> np.ndarray:
    return np.floor(SCALE * np.stack(batch.to_list())).astype(np.int64) + OFFSET


def added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], whole: bool) -> np.ndarray:
    """The sum over all batches of the matrices that `part` makes of a batch of whole numbers."""
    kind = np.int64 if whole else np.float64

    def local(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in filter(len, batches):
            x = whole_numbers(batch["v"])
            for at in range(0, len(x), BATCH):
                own = part(x[at : at + BATCH]).astype(kind)
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "sums": [row.tobytes() for row in total]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, kind) for b in group["sums"])
        return group.head(1).assign(sums=[total.tobytes()])

    made = rows.select("v").mapInPandas(local, "i long, sums binary")
    dealt = made.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(SLOTS)))
    first = dealt.groupBy("i", "slot").applyInPandas(add, "i long, sums binary, slot int")
    sums = first.groupBy("i").applyInPandas(add, "i long, sums binary, slot int").toPandas().sort_values("i")
    return np.stack([np.frombuffer(b, kind) for b in sums["sums"]])


def moments(rows: DataFrame, n: int, span: int) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Whole quotients and remainders of the dimensions' sums by n, and the covariance."""
    # Sums in two halves: each stays a long for any number of rows there can be.
    half = 1 << 30
    sums = added(rows, lambda x: np.stack([(x // half).sum(axis=0), (x % half).sum(axis=0)]), True)
    totals = [int(a) * half + int(b) for a, b in zip(*sums.tolist(), strict=True)]
    base, rest = np.array([t // n for t in totals], np.int64), [t % n for t in totals]

    def products(x: np.ndarray) -> np.ndarray:
        u = (x - base).astype(np.float64)
        return u.T @ u

    # A batch's products are exact in doubles and their sum exact in longs; entries of unusual size are rounded.
    exact = span**2 * BATCH < 2**53 and span**2 * n < 2**62
    found = added(rows, products, exact)
    if exact:
        own = np.array(found.tolist(), object) * n - np.outer(np.array(rest, object), np.array(rest, object))
        v = np.array([[float(Fraction(x, n * n)) for x in row] for row in own.tolist()])
    else:
        part = np.array([r / n for r in rest])
        v = found / n - np.outer(part, part)
    return base, rest, (v + v.T) / 2


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    `deviation` is the exact squared distance of n times the vector from the sums; `whitened` the centred vector along the
    component over the eigenvalue's root; `explained` the component's share of all variance; `identity_error` the
    largest departure of the whitened vectors' covariance from the identity.
    """
    rows, n, span = usable(embeddings, id_column, column)
    schema = "whitened array<double>, deviation long"
    values, axes, error, base, rest = np.zeros(0), np.zeros((0, 0)), 0.0, None, []
    if n:
        base, rest, covariance = moments(rows, n, span)
        values, axes = leading(covariance, components)
    if not len(values):
        rows = rows.limit(0)
    else:
        share = np.array([r / n for r in rest])
        scaled = (axes / np.sqrt(values)[:, None]).T

        def products(x: np.ndarray) -> np.ndarray:
            z = ((x - base) - share) @ scaled
            return np.vstack([z.sum(axis=0), z.T @ z])

        sums = added(rows, products, False) / n
        error = float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(len(values))).max())
        explained = F.array(*(F.lit(float(e)) for e in values / np.trace(covariance)))
        remainders = np.array(rest, object)

    @F.pandas_udf(schema)
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                yield pd.DataFrame({"whitened": [], "deviation": pd.Series([], dtype="Int64")})
                continue
            u = whole_numbers(batch) - base
            if u.shape[1] * (n * (span + 1)) ** 2 < 2**63:
                own = n * u - np.array(rest, np.int64)
                deviation = (own * own).sum(axis=1).tolist()
            else:
                exact = ((n * u.astype(object) - remainders) ** 2).sum(axis=1).tolist()
                deviation = [x if x < 2**63 else None for x in exact]
            yield pd.DataFrame({"whitened": list((u - share) @ scaled), "deviation": pd.array(deviation, "Int64")})

    if not len(values):
        parts = rows.select("vec_id", F.array().cast("array<double>").alias("whitened"), F.lit(0).cast("long").alias("deviation"))
        explained = F.array().cast("array<double>")
    else:
        parts = rows.select("vec_id", project("v").alias("x")).select("vec_id", "x.whitened", "x.deviation")
    return parts.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
