"""Whitening of embeddings by a one-sided Jacobi singular value decomposition.

Entries become integers, so counts and sums are exact.  Each task compresses its
centred rows block by block to one triangular factor R (a QR of the last R and
the next block), and the tasks' factors are compressed in a tree on the
executors; the last R has a row a dimension and stands for all rows.  Plane
rotations make R's columns orthogonal; together they are the components, the
columns' lengths over sqrt(n) the standard deviations.  No product of the data
with itself is formed, so small deviations keep their digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .tables import kept

#: How many groups each level of the tree has.
_LEVELS = (4096, 256, 16, 1)
#: Entries beyond this are not exact in doubles.
_MOST = 2**52


@dataclass(frozen=True)
class Whitening:
    """components: the most that are returned; scale, shift: an entry c becomes floor(scale * c) + shift; block: rows of one QR."""

    components: int = 8
    scale: int = 1024
    shift: int = 100_000
    block: int = 4096


def _integers(vectors: DataFrame, o: Whitening, key: str, column: str) -> DataFrame:
    """(vec_id, x): the integer entries of each usable vector, eight bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = np.diff(np.asarray(lists.offsets))
            values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            size[~np.asarray(lists.is_valid())] = 0
            scaled = np.floor(o.scale * values)
            bad = ~(np.abs(scaled) < _MOST)
            ends = np.concatenate([[0], np.cumsum(size)])
            good = (X.per_row(bad.astype(np.int64), ends) == 0) & np.asarray(lists.is_valid())
            x = (np.where(bad, 0, scaled).astype(np.int64) + o.shift).view(np.uint8)
            spots = np.flatnonzero(good)
            data = [x[8 * ends[i] : 8 * ends[i + 1]].tobytes() for i in spots]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(spots)), pa.array(data, type=pa.binary())], names=["vec_id", "x"])

    return vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).mapInArrow(X.tidied(run), "vec_id long, x binary")


def _matrix(column: pa.Array, width: int, fill: int) -> np.ndarray:
    """The rows' integers; a shorter vector's missing entries are zeros before scaling, ``fill`` after it."""
    raw = column.to_pylist()
    if all(len(b) == 8 * width for b in raw):
        return np.frombuffer(b"".join(raw), dtype=np.int64).reshape(len(raw), width)
    out = np.full((len(raw), width), fill, dtype=np.int64)
    for i, b in enumerate(raw):
        out[i, : len(b) // 8] = np.frombuffer(b, dtype=np.int64)
    return out


class _Centre:
    """n * x - S, exactly, and what follows from it."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums, self.small = n, sums, max(map(abs, sums), default=0) < 2**61

    def exact(self, x: np.ndarray) -> np.ndarray:
        """In 64 bits where they hold it, else in Python's integers."""
        if self.small and int(np.abs(x).max(initial=0)) * self.n < 2**61:
            return x * self.n - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum of squares of exact() for each row: in two parts of a number where their products fit into 64 bits."""
        y = self.exact(x)
        bits = (62 - max(1, y.shape[1]).bit_length()) // 2
        if y.dtype == object or int(np.abs(y).max(initial=0)) >> (2 * bits):
            return [sum(int(v) ** 2 for v in row) for row in y]
        high, low = y >> bits, y & ((1 << bits) - 1)
        parts = [(p * q).sum(axis=1).tolist() for p, q in ((high, high), (high, low), (low, low))]
        return [(a << (2 * bits)) + (b << (bits + 1)) + c for a, b, c in zip(*parts, strict=True)]


def _tree(parts: DataFrame, combine: Callable[[list[bytes]], bytes]) -> bytes | None:
    """All of (part, state) combined into one, a bounded number at a time."""

    def solve(table: pa.Table) -> pa.Table:
        return pa.table({"part": table.column("part").slice(0, 1).cast(pa.int32()), "state": pa.array([combine(table.column("state").to_pylist())], type=pa.binary())})

    for groups in _LEVELS:
        parts = parts.withColumn("part", F.pmod("part", F.lit(groups))).groupBy("part").applyInArrow(solve, "part int, state binary")
    last = parts.first()
    return None if last is None else bytes(last["state"])


def _folded(rows: DataFrame, start: Callable[[], object], add: Callable[[object, pa.RecordBatch], object], pack: Callable[[object], bytes], combine: Callable[[list[bytes]], bytes]) -> bytes | None:
    """A state that each task builds from its rows, combined over all tasks; None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, part = None, 0
        for batch in batches:
            if batch.num_rows:
                state, part = add(start() if state is None else state, batch), batch.column(2)[0].as_py()
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], type=pa.int32()), pa.array([pack(state)], type=pa.binary())], names=["part", "state"])

    return _tree(rows.select("vec_id", "x", F.spark_partition_id().alias("part")).mapInArrow(X.tidied(run), "part int, state binary"), combine)


def _sums(rows: DataFrame, width: int, o: Whitening) -> list[int]:
    """The exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            x = _matrix(batch.column(0), width, o.shift)
            if int(np.abs(x).max(initial=0)) * len(x) >= 2**62:
                x = x.astype(object)
            total = [t + int(s) for t, s in zip(total, x.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), type=pa.int32()), pa.array(total, type=pa.decimal128(38, 0))], names=["dim", "total"])

    found = rows.select("x").mapInArrow(X.tidied(run), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    return [int(r["total"]) for r in found.orderBy("dim").collect()]


def tsqr(rows: DataFrame, width: int, centre: _Centre, o: Whitening) -> np.ndarray:
    """R of the centred rows, at most a row a dimension."""

    def add(r: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        for lo in range(0, batch.num_rows, o.block):
            r = np.linalg.qr(np.vstack([r, centre.rows(_matrix(batch.column(1).slice(lo, o.block), width, o.shift))]), mode="r")
        return r

    def combine(states: list[bytes]) -> bytes:
        r = np.zeros((0, width))
        for s in states:
            r = np.linalg.qr(np.vstack([r, np.frombuffer(s).reshape(-1, width)]), mode="r")
        return r.tobytes()

    return np.frombuffer(_folded(rows, lambda: np.zeros((0, width)), add, np.ndarray.tobytes, combine)).reshape(-1, width)


def jacobi(r: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, components as columns), falling: rotations of pairs of columns until all are orthogonal.

    The pairs of a round have no column in common, so a round is one step; after
    as many rounds as there are columns less one, each pair has met.
    """
    width = r.shape[1]
    even = width + width % 2
    a, v = np.zeros((max(len(r), 1), even)), np.eye(even)
    a[: len(r), :width] = r
    order = np.arange(even)
    # Columns whose squares are lost in rounding beside the largest have no direction of their own.
    floor = (np.finfo(float).eps * np.linalg.norm(a)) ** 2
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(even - 1):
            p, q = order[: even // 2], order[even // 2 :][::-1]
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            solid = (xx > floor) & (yy > floor)
            off = np.where(solid, np.abs(xy) / np.sqrt(np.where(solid, xx * yy, 1)), 0)
            worst = max(worst, off.max(initial=0))
            turn = off > 1e-16
            zeta = (yy - xx) / np.where(turn, 2 * xy, 1)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = np.where(turn, 1 / np.hypot(1, t), 1)
            s = np.where(turn, c * t, 0)
            for m in (a, v):
                left, right = m[:, p], m[:, q]
                m[:, p], m[:, q] = c * left - s * right, s * left + c * right
            order = np.concatenate([order[:1], np.roll(order[1:], 1)])
        if worst <= 1e-15:
            break
    sigma, v = np.linalg.norm(a[:, :width], axis=0), v[:width, :width]
    fall = np.argsort(-sigma, kind="stable")
    return sigma[fall], v[:, fall]


def _identity_error(rows: DataFrame, width: int, project: Callable[[np.ndarray], np.ndarray], count: int, o: Whitening) -> float:
    """How far the covariance of the whitened rows is from the identity: blocks are centred by their own means, then merged."""

    def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
        n = one[0, 0] + other[0, 0]
        if not one[0, 0] or not other[0, 0]:
            return one if one[0, 0] else other
        apart = other[1, :count] - one[1, :count]
        out = np.zeros_like(one)
        out[0, 0], out[1, :count] = n, one[1, :count] + apart * (other[0, 0] / n)
        out[2:] = one[2:] + other[2:] + np.outer(apart, apart) * (one[0, 0] * other[0, 0] / n)
        return out

    def add(state: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        y = project(_matrix(batch.column(1), width, o.shift))
        own = np.zeros_like(state)
        own[0, 0], own[1] = len(y), y.mean(axis=0)
        own[2:] = (y - own[1]).T @ (y - own[1])
        return merge(state, own)

    def combine(states: list[bytes]) -> bytes:
        out = np.zeros((count + 2, count))
        for s in states:
            out = merge(out, np.frombuffer(s).reshape(count + 2, count))
        return out.tobytes()

    whole = np.frombuffer(_folded(rows, lambda: np.zeros((count + 2, count)), add, np.ndarray.tobytes, combine)).reshape(count + 2, count)
    return float(np.abs(whole[2:] / whole[0, 0] - np.eye(count)).max())


def whiten(vectors: DataFrame, o: Whitening | None = None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each usable row and each of the first components.

    Rows take part whose vector is there and holds no null, no entry that isn't
    finite and none beyond 2**52 after scaling; an id may be null or repeated, each
    row is one of its own.  A shorter vector is filled with zeros.  deviation is
    an exact decimal.  A component without variance (fewer directions than
    dimensions, equal rows, one row) has a null whitened and doesn't count in
    identity_error, which is 0 where none has any; explained is 0 where nothing
    varies.  No usable rows, or only empty vectors, give no rows; other columns
    are not looked at.
    """
    o = o or Whitening()
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = kept(_integers(vectors, o, key, column), "integers")
    about = rows.agg(F.count("*").alias("n"), F.max(F.length("x")).alias("bytes")).first()
    if not about["n"] or not about["bytes"]:
        return vectors.sparkSession.createDataFrame([], schema)
    n, width = about["n"], about["bytes"] // 8
    centre = _Centre(n, _sums(rows, width, o))
    sigma, axes = jacobi(tsqr(rows, width, centre, o))
    power = sigma**2 / n
    shown = min(o.components, width)
    varies = (sigma > np.finfo(float).eps * max(n, width) ** 0.5 * sigma[0]) & (sigma > 0)
    solid = int(varies[:shown].sum())
    scaled = axes[:, :solid] / np.sqrt(power[:solid])
    explained = power[:shown] / power.sum() if power.sum() > 0 else np.zeros(shown)
    project = lambda x: centre.rows(x) @ scaled
    error = _identity_error(rows, width, project, solid, o) if solid else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, o.block):
                x = _matrix(batch.column(1).slice(lo, o.block), width, o.shift)
                y = np.full((len(x), shown), np.nan)
                y[:, :solid] = project(x)
                at, flat = pa.array(np.repeat(np.arange(len(x)), shown)), y.reshape(-1)
                many = len(flat)
                columns = [
                    batch.column(0).slice(lo, o.block).take(at),
                    pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(many, n, dtype=np.int64)),
                    pa.array(centre.deviations(x), type=pa.decimal128(38, 0)).take(at),
                    pa.array(flat, mask=np.isnan(flat)),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(many, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(X.tidied(run), schema)
