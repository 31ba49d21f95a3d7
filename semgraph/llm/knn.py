"""Exact top-k search by inner product: a Voronoi join.

Vectors are assigned to the nearest of a bounded number of pivots.  Summaries of
each cell (its size, radius, norms, and the distances of its innermost ids) give
for the queries of a cell a lower bound of their k-th best score, and for each
vector an upper bound of its score with any of them.  Query cells that need
much the same data are put into one group, by what sending and comparing would
cost; a vector is sent to the groups where its bound reaches, each group is
solved locally in blocks, and the blocks' best merge.

For q near pivot p with |q - p| <= r, and x near c with |x - c| <= e:
    |q - x| <= |p - c| + r + e,  |q - x| >= |x - p| - r,  q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2,
    p.c - r|c| - |p|e - re <= q.x <= p.x + r|x|.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textops as X
from .tables import kept


@dataclass(frozen=True)
class Knn:
    """cell: vectors a cell should hold; pivots: the most cells (their table and summaries are all that tasks and driver hold); block: rows of one side of a local product; send, compare: what sending a row and comparing a pair cost, in any one unit."""

    k: int = 20
    scale: int = 64
    cell: int = 512
    pivots: int = 512
    block: int = 8192
    send: float = 3e-6
    compare: float = 1.5e-8


def usable(vectors: DataFrame, key: str, column: str, scale: int) -> DataFrame:
    """(vec_id, v): the rows with an id and a vector that holds no null and no component that isn't finite, before or after scaling."""
    x = F.col(column).cast("array<double>")
    good = F.col(key).isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < float("inf")))
    return vectors.where(good).select(F.col(key).cast("long").alias("vec_id"), x.alias("v"))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), width)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point where no partial sum can pass 2**53."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    return (a @ b.T).astype(np.int64) if most < 2**53 else a.astype(np.int64) @ b.astype(np.int64).T


def _quantised(found: DataFrame, width: int, scale: int) -> DataFrame:
    """(vec_id, v, query): floor(scale * x) of each component as packed doubles; shorter vectors are filled with 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1):
                whole = np.zeros(width)
                own = np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float64)
                whole[: len(own)] = np.floor(scale * own)
                out.append(whole.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.binary()), batch.column(2)], names=["vec_id", "v", "query"])

    return found.mapInArrow(X.tidied(run), "vec_id long, v binary, query boolean")


class _Cells:
    """What driver and tasks know of the cells: pivots, and which rows each group of query cells needs."""

    def __init__(self, centres: np.ndarray, sums: list, inner: list, o: Knn):
        self.centres, self.size = centres, np.linalg.norm(centres, axis=1)
        cells = np.array([r["cell"] for r in sums])
        rows, radius, low, high = (np.array([r[c] for r in sums], dtype=np.float64) for c in ("n", "radius", "low", "high"))
        asked = [r for r in sums if r["queries"]]
        self.asked = np.array([r["cell"] for r in asked], dtype=np.int64)
        self.queries = np.array([r["queries"] for r in asked], dtype=np.int64)
        self.reach = np.array([r["reach"] for r in asked], dtype=np.float64)
        self.top = np.array([r["top"] for r in asked], dtype=np.float64)
        bottom = np.array([r["bottom"] for r in asked], dtype=np.float64)
        if not asked:
            return
        p, spot = centres[self.asked], {int(c): i for i, c in enumerate(cells)}
        at = np.array([spot[r["cell"]] for r in inner], dtype=np.int64)
        near = np.array([r["far"] for r in inner], dtype=np.float64)
        ids = np.array([r["vec_id"] for r in inner], dtype=np.int64)
        c = centres[cells]
        dot, apart = p @ c.T, np.sqrt(np.maximum((self.size[self.asked] ** 2)[:, None] + self.size[cells] ** 2 - 2 * p @ c.T, 0))
        self.least = np.full(len(asked), -np.inf)  # of the k-th best score of any query of the cell
        for g in range(len(asked)):
            r = self.reach[g]
            linear = dot[g][at] - r * self.size[cells][at] - self.size[self.asked[g]] * near - r * near
            ball = (bottom[g] ** 2 + low[at] ** 2 - (apart[g][at] + r + near) ** 2) / 2
            bound = np.maximum(linear, ball)
            order = np.argsort(-bound, kind="stable")
            _, first = np.unique(ids[order], return_index=True)  # of an id's rows, the best; one id may be the query's own
            best = np.sort(bound[order][first])[::-1]
            if len(best) > o.k:
                self.least[g] = best[o.k]
        self.least -= 1e-9 * (self.top**2 + high.max() ** 2 + 1)
        gap = np.maximum(apart - self.reach[:, None] - radius, 0)
        r = self.reach[:, None]
        most = np.minimum((self.top[:, None] ** 2 + high**2 - gap**2) / 2, dot + r * self.size[cells] + self.size[self.asked][:, None] * radius + r * radius)
        self._group(most >= self.least[:, None], rows, o)

    def _group(self, needs: np.ndarray, rows: np.ndarray, o: Knn) -> None:
        """Joins query cells while that spares more sending than it adds comparing; sets group (of each query cell), parts and slots."""
        union, count, self.group = np.zeros((0, len(rows)), dtype=bool), np.zeros(0, np.int64), np.zeros(len(needs), np.int64)
        for g in np.argsort(-self.queries, kind="stable"):
            q, own = self.queries[g], needs[g] @ rows
            both = (union | needs[g]) @ rows
            alone = union @ rows
            spared = o.send * (own + alone - both) - o.compare * (q * (both - own) + count * (both - alone))
            spared[count + q > o.block] = -1
            best = int(spared.argmax()) if len(spared) else -1
            if best < 0 or spared[best] < 0:
                best, union, count = len(count), np.vstack([union, needs[g]]), np.append(count, q)
            else:
                union[best] |= needs[g]
                count[best] += q
            self.group[g] = best
        self.parts = -(-count // o.block)
        self.slots = np.maximum(1, -(-(union @ rows).astype(np.int64) // o.block))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each row and its distance from the pivot."""
        cell = (self.size**2 - 2 * x @ self.centres.T).argmin(axis=1) if len(x) else np.zeros(0, np.int64)
        return cell, np.linalg.norm(x - self.centres[cell], axis=1)

    def wanted(self, x: np.ndarray) -> np.ndarray:
        """(row, group): whether a row may be among the best k of a query of the group."""
        p, norm = self.centres[self.asked], (x**2).sum(axis=1)[:, None]
        dot = x @ p.T
        gap = np.maximum(np.sqrt(np.maximum(norm + self.size[self.asked] ** 2 - 2 * dot, 0)) - self.reach, 0)
        reached = np.minimum((self.top**2 + norm - gap**2) / 2, dot + np.sqrt(norm) * self.reach) >= self.least
        out = np.zeros((len(x), len(self.parts)), dtype=bool)
        for g in range(len(self.asked)):
            out[:, self.group[g]] |= reached[:, g]
        return out


def _plan(vectors: DataFrame, is_query: Column, o: Knn, key: str, column: str) -> tuple[DataFrame, _Cells] | None:
    """The assigned rows (vec_id, v, query, cell, far, norm) and the cells; None where there are no queries."""
    found = usable(vectors, key, column, o.scale).withColumn("query", F.coalesce(is_query, F.lit(False)))
    about = found.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not about["n"] or not about["width"]:
        return None
    n, width = about["n"], about["width"]
    data = _quantised(found, width, o.scale)
    chosen = data.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(min(o.pivots, -(-n // o.cell))).select("v").collect()
    cells = _Cells(np.unique(np.stack([np.frombuffer(r["v"], dtype=np.float64) for r in chosen]), axis=0), [], [], o)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(1), width)
            cell, far = cells.assign(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far), pa.array(np.linalg.norm(x, axis=1))], names=["vec_id", "v", "query", "cell", "far", "norm"])

    celled = kept(data.mapInArrow(X.tidied(assign), "vec_id long, v binary, query boolean, cell int, far double, norm double"), "cells")
    of_query = lambda c: F.when(F.col("query"), F.col(c))
    sums = celled.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("far").alias("radius"), F.min("norm").alias("low"), F.max("norm").alias("high"),
        F.count_if("query").alias("queries"), F.max(of_query("far")).alias("reach"), F.min(of_query("norm")).alias("bottom"), F.max(of_query("norm")).alias("top"),
    ).collect()
    # The innermost ids of each cell; first by sixteenths, so that no task sees more of a cell than that.
    salted = Window.partitionBy("cell", F.pmod(F.xxhash64("vec_id"), F.lit(16))).orderBy("far", "vec_id")
    first = celled.select("cell", "vec_id", "far").withColumn("i", F.row_number().over(salted)).where(F.col("i") <= o.k + 1)
    inner = first.groupBy("cell", "vec_id").agg(F.min("far").alias("far")).withColumn("i", F.row_number().over(Window.partitionBy("cell").orderBy("far", "vec_id"))).where(F.col("i") <= o.k + 1)
    cells = _Cells(cells.centres, sums, inner.select("cell", "vec_id", "far").collect(), o)
    return (celled, cells) if len(cells.asked) else None


def top_k(vectors: DataFrame, is_query: Column, o: Knn | None = None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``o.k`` rows for each id where ``is_query`` (over ``vec_id``) holds.

    A query meets the rows of all other ids.  Ties go to the smaller id; with
    fewer candidates all are given.  Ids and vectors that are null, or that hold
    null or non-finite components (``o.scale`` times x included), take no part.
    Of a repeated id each row is a candidate, and where it is a query all its
    rows' results are ranked together.  Shorter vectors are filled with 0;
    scores of more than 64 bits are not defined.  No rows or no queries give no
    rows; other columns are not looked at.
    """
    o = o or Knn()
    schema = "query_id long, rank int, vec_id long, score long"
    planned = _plan(vectors, is_query, o, key, column)
    if planned is None:
        return vectors.sparkSession.createDataFrame([], schema)
    celled, cells = planned
    width = cells.centres.shape[1]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                ids, v = batch.column(0).slice(lo, 2048), batch.column(1).slice(lo, 2048)
                wanted = cells.wanted(_rows(v, width))
                # By place too, so that the rows of one id are dealt out as others are.
                h = X.mix(ids.to_numpy().astype(np.uint64) ^ X.mix(np.arange(lo, lo + len(ids), dtype=np.uint64))) >> np.uint64(16)
                for g in range(len(cells.parts)):
                    at = np.flatnonzero(wanted[:, g])
                    for part in range(int(cells.parts[g]) if len(at) else 0):
                        keys = [np.full(len(at), g), np.full(len(at), part), h[at] % np.uint64(cells.slots[g])]
                        yield pa.RecordBatch.from_arrays([*(pa.array(k.astype(np.int32)) for k in keys), ids.take(pa.array(at)), v.take(pa.array(at))], names=["grp", "part", "slot", "vec_id", "v"])

    sent = celled.select("vec_id", "v").mapInArrow(X.tidied(send), "grp int, part int, slot int, vec_id long, v binary")
    places = vectors.sparkSession.createDataFrame([(int(c), int(g), int(cells.parts[g]), int(cells.slots[g])) for c, g in zip(cells.asked, cells.group, strict=True)], "cell int, grp int, parts int, slots int")
    # One row for each of at most o.pivots cells.
    queries = celled.where("query").join(F.broadcast(places), "cell")
    queries = queries.select("grp", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"), "vec_id", "v")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        ask, ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        q, x = _rows(left.column("v").combine_chunks(), width), _rows(right.column("v").combine_chunks(), width)[order]
        out = []
        for lo in range(0, len(ask) if len(ids) else 0, 256):
            score = _product(q[lo : lo + 256], x)
            score[ask[lo : lo + 256, None] == ids] = np.iinfo(np.int64).min
            keep = min(o.k + 1, len(ids))
            bound = np.partition(score, len(ids) - keep, axis=1)[:, len(ids) - keep]
            for r in range(len(score)):
                at = np.flatnonzero(score[r] >= bound[r])
                at = at[np.argsort(-score[r][at], kind="stable")]
                at = at[ids[at] != ask[lo + r]][: o.k]
                out.append((np.full(len(at), ask[lo + r]), ids[at], score[r][at]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(c, type=pa.int64()) for c in columns), strict=True)))

    keys = ["grp", "part", "slot"]
    best = queries.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= o.k).select("query_id", "rank", "vec_id", "score")
