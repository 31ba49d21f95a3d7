"""Nearest neighbours by largest inner product: multiprobe p-stable hashing.

Vectors get one coordinate more, which makes all of the same length, so that the
largest inner product is the smallest distance; queries are scaled to that
length.  A table has some functions floor((a.x + b) / w) with normal a; a row
lies in the bucket of their values.  For a query, the chance that a neighbour at
a given distance lies in a bucket is a product of one normal integral a function;
the buckets are visited in falling order of that chance until their chances add
up to what the wanted recall asks of one table.  A first look at the likeliest
buckets of one table gives each query a score that its k-th best can't be below;
then all tables' candidates meet their queries in blocks, are scored exactly, and
those that reach that bound merge.

The distance that neighbours have, and how many functions make buckets of the
wanted size, come from a bounded sample (``pilots`` queries against all rows,
``sample`` rows); every row is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from . import textops as X
from .knn import usable
from .tables import kept


@dataclass(frozen=True)
class Ann:
    """k: neighbours; tables; width: of a slot, in neighbours' distances; cell: rows of a usual bucket; recall: what the visited buckets should hold; first: what those of the first look should hold; functions: the most a table has; probes: the most buckets of a table that a query visits; pilots, sample: queries and rows that the fit looks at; block: rows of one side of a local product; listed: how many large groups of buckets are told to all tasks."""

    k: int = 20
    tables: int = 4
    width: float = 2.0
    cell: int = 1024
    recall: float = 0.96
    first: float = 0.3
    functions: int = 24
    probes: int = 4096
    pilots: int = 64
    sample: int = 4096
    block: int = 8192
    listed: int = 1_000_000
    seed: int = 7


def _normal(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, to five digits (Zelen and Severo's polynomial)."""
    t = 1 / (1 + 0.33267 * np.abs(x))
    tail = np.exp(-x * x / 2) / np.sqrt(2 * np.pi) * t * (0.4361836 + t * (-0.1201676 + t * 0.9372980))
    return np.where(x > 0, 1 - tail, tail)


def _rows(column: pa.Array, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), width).astype(np.float64)


def _packed(found: DataFrame, width: int, kind: str) -> DataFrame:
    """(vec_id, v, norm, query): vectors as bytes, shorter ones filled with 0; those of length 0 or beyond doubles are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, width))
            for i, v in enumerate(batch.column(1)):
                x[i, : len(v)] = v.values.to_numpy(zero_copy_only=False)
            # An entry whose square is 0 in doubles still counts: scaled by the largest first.
            top = np.abs(x).max(axis=1, initial=0)
            norm = top * np.sqrt(((x / np.where(top > 0, top, 1)[:, None]) ** 2).sum(axis=1))
            at = np.flatnonzero((top > 0) & np.isfinite(norm * norm))
            data = [r.tobytes() for r in x[at].astype(kind)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(data, type=pa.binary()), pa.array(norm[at]), batch.column(2).take(pa.array(at))], names=["vec_id", "v", "norm", "query"])

    return found.mapInArrow(X.tidied(run), "vec_id long, v binary, norm double, query boolean")


def likeliest(chance: np.ndarray, enough: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the slots of its likeliest buckets, in falling order of their chances, those chances, and how many reach ``enough`` (or all of ``most``).

    chance: (query, function, slot).  The best m beginnings of a bucket hold the
    beginnings of the best m buckets, so keeping m a function loses none.
    """
    n, functions, slots = chance.shape
    keep = 64
    while True:
        found, codes = np.ones((n, 1)), np.zeros((n, 1, 0), dtype=np.int8)
        for j in range(functions):
            each = (found[:, :, None] * chance[:, j, None, :]).reshape(n, -1)
            m = min(keep, each.shape[1])
            at = np.argpartition(-each, m - 1, axis=1)[:, :m] if m < each.shape[1] else np.broadcast_to(np.arange(m), (n, m))
            found = np.take_along_axis(each, at, axis=1)
            codes = np.concatenate([np.take_along_axis(codes, (at // slots)[:, :, None], axis=1), (at % slots)[:, :, None].astype(np.int8)], axis=2)
        whole = slots**functions <= keep
        if whole or keep >= most or (found.sum(axis=1) >= enough).all():
            break
        keep = min(4 * keep, most)
    order = np.argsort(-found, axis=1, kind="stable")
    found, codes = np.take_along_axis(found, order, axis=1), np.take_along_axis(codes, order[:, :, None], axis=1)
    count = np.minimum((np.cumsum(found, axis=1) < enough).sum(axis=1) + 1, found.shape[1])
    return codes, found, count


class Hashes:
    """The tables' functions, and what is known of neighbours' distances."""

    def __init__(self, near: float, top: float, sample: np.ndarray, rows: int, o: Ann):
        self.o, self.top, self.near = o, top, max(near, 1e-3 * top)
        self.w = o.width * self.near
        random = np.random.default_rng(o.seed)
        size = sample.shape[1] + 1
        self.a, self.b = random.standard_normal((o.tables, o.functions, size)), random.uniform(0, self.w, (o.tables, o.functions))
        self.reach = int(np.ceil(3.5 / o.width))
        #: How many functions a table needs until a usual row's bucket holds no more than o.cell rows.
        self.count = []
        for t in range(o.tables):
            slots, share = self.slots(t, self.grown(sample, np.linalg.norm(sample, axis=1)), o.functions), np.ones(len(sample))
            for j in range(o.functions):
                _, place, times = np.unique(slots[:, j], return_inverse=True, return_counts=True)
                share *= times[place] / len(sample)
                if np.median(share) * rows <= o.cell:
                    break
            self.count.append(j + 1)
        self.enough = 1 - (1 - o.recall) ** (1 / o.tables)

    def grown(self, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Rows with the coordinate that makes them all as long as the longest."""
        return np.column_stack([x, np.sqrt(np.maximum(self.top**2 - norm**2, 0))])

    def slots(self, table: int, x: np.ndarray, functions: int | None = None) -> np.ndarray:
        return np.floor(self._at(table, x, functions)).astype(np.int64)

    def _at(self, table: int, x: np.ndarray, functions: int | None = None) -> np.ndarray:
        f = functions or self.count[table]
        return (x @ self.a[table, :f].T + self.b[table, :f]) / self.w

    def bucket(self, slots: np.ndarray) -> np.ndarray:
        """64 bits of the slots along the last axis."""
        out = np.full(slots.shape[:-1], np.uint64(slots.shape[-1]))
        for j in range(slots.shape[-1]):
            out = X.mix(out + slots[..., j].astype(np.uint64))
        return out.view(np.int64)

    def probes(self, table: int, q: np.ndarray, norm: np.ndarray, enough: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, buckets) that the queries visit until their chances add up to ``enough``, some queries at a time."""
        x = np.column_stack([q * (self.top / norm)[:, None], np.zeros(len(q))])
        at = self._at(table, x)
        home = np.floor(at)
        offsets = np.arange(-self.reach, self.reach + 1)
        edge = (offsets[None, None, :] - (at - home)[:, :, None]) * self.o.width
        chance = _normal(edge + self.o.width) - _normal(edge)
        for lo in range(0, len(q), 64):
            codes, _, count = likeliest(chance[lo : lo + 64], enough, self.o.probes)
            wanted = np.arange(codes.shape[1]) < count[:, None]
            buckets = self.bucket(home[lo : lo + 64, None, :].astype(np.int64) + offsets[codes])
            yield lo + np.nonzero(wanted)[0], buckets[wanted]


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in the order of the dimensions: the same wherever a pair is met."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * x[:, j]
    return out


def _solve(left: pa.Table, right: pa.Table, width: int, kind: str, k: int) -> pa.Table:
    """Up to k rows for each query of the buckets that it visits, by their exact scores; left: (vec_id, v, least, buckets), right: (vec_id, v, bucket)."""
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if left.num_rows and right.num_rows:
        ask, least, q = left.column("vec_id").to_numpy(), left.column("least").to_numpy(), _rows(left.column("v").combine_chunks(), width, kind)
        raw = left.column("buckets").to_pylist()
        visited = np.frombuffer(b"".join(raw), dtype=np.int64)
        who = np.repeat(np.arange(len(ask)), [len(b) // 8 for b in raw])
        order = np.argsort(visited, kind="stable")
        visited, who = visited[order], who[order]
        bucket = right.column("bucket").to_numpy()
        order = np.argsort(bucket, kind="stable")
        bucket, ids, x = bucket[order], right.column("vec_id").to_numpy()[order], _rows(right.column("v").combine_chunks(), width, kind)[order]
        slack = 1e-12 * np.abs(q).sum(axis=1) * np.abs(x).max(initial=0)
        for one in np.intersect1d(visited, bucket):
            lo, hi = np.searchsorted(bucket, one, side="left"), np.searchsorted(bucket, one, side="right")
            mine = who[np.searchsorted(visited, one, side="left") : np.searchsorted(visited, one, side="right")]
            for some in np.array_split(mine, -(-len(mine) // 256)):
                score = q[some] @ x[lo:hi].T
                score[ask[some][:, None] == ids[lo:hi]] = -np.inf
                bound = least[some]
                if hi - lo > 4 * k:  # repeated ids may stand among the best, so as many more are kept as there are
                    spare = k + (hi - lo) - len(np.unique(ids[lo:hi]))
                    if spare < hi - lo:
                        bound = np.maximum(bound, np.partition(score, hi - lo - spare, axis=1)[:, hi - lo - spare])
                r, c = np.nonzero((score >= (bound - 2 * slack[some])[:, None]) & (score > -np.inf))
                for at in range(0, len(r), 1 << 16):
                    mine_at, rows_at = some[r[at : at + (1 << 16)]], lo + c[at : at + (1 << 16)]
                    parts.append((mine_at, ids[rows_at], _exact(q[mine_at], x[rows_at])))
    who_, found, sure = (np.concatenate(c) for c in zip(*parts, strict=True))
    query = left.column("vec_id").to_numpy()[who_] if len(who_) else who_
    order = np.lexsort((-sure, found, query))
    query, found, sure = query[order], found[order], sure[order]
    first = np.ones(len(query), dtype=bool)
    first[1:] = (query[1:] != query[:-1]) | (found[1:] != found[:-1])
    query, found, sure = query[first], found[first], sure[first]
    order = np.lexsort((found, -sure, query))
    query, found, sure = query[order], found[order], sure[order]
    best = np.arange(len(query)) - np.searchsorted(query, query) < k
    return pa.table({"query_id": pa.array(query[best], type=pa.int64()), "vec_id": pa.array(found[best], type=pa.int64()), "score": pa.array(sure[best], type=pa.float64())})


def _pilot_distance(rows: DataFrame, pilots: np.ndarray, asked: np.ndarray, norms: np.ndarray, top: float, width: int, kind: str, o: Ann) -> float:
    """The distance within which nine of ten pilots have their k neighbours, by brute force over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(pilots), o.k), -np.inf)
        for batch in batches:
            score = pilots @ _rows(batch.column(1), width, kind).T
            score[asked[:, None] == batch.column(0).to_numpy()] = -np.inf
            best = -np.sort(-np.hstack([best, score]), axis=1)[:, : o.k]
        at = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(at[0].astype(np.int32)), pa.array(best[at])], names=["pilot", "score"])

    found = rows.select("vec_id", "v").mapInArrow(X.tidied(run), "pilot int, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("pilot").orderBy(F.desc("score")))).where(F.col("rank") <= o.k)
    least = ranked.groupBy("pilot").agg(F.min("score").alias("score")).collect()
    far = [np.sqrt(max(0.0, 2 * top * top - 2 * top * r["score"] / norms[r["pilot"]])) for r in least]
    return float(np.quantile(far, 0.9)) if far else top


def nearest(vectors: DataFrame, is_query: Column, o: Ann | None = None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): up to ``o.k`` rows found for each id where ``is_query`` (over ``vec_id``) holds, nearest first.

    score is the inner product of the original vectors in doubles, ties go to the
    smaller id; a query meets other ids only.  Ids and vectors that are null, and
    vectors that are zero or hold null or non-finite components (or whose squared
    length isn't finite), take no part.  Of a repeated id the best row counts, once; a shorter
    vector is filled with 0.  With no more rows than two usual buckets hold, all
    are candidates.  No rows or no queries give no rows; other columns are not
    looked at.  Large groups of buckets are dealt to several tasks, and of equal vectors of
    a batch only the k + 1 smallest ids, which no result can go beyond, are sent.
    """
    o = o or Ann()
    spark, schema = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    kind = "<f4" if isinstance(getattr(vectors.schema[column].dataType, "elementType", None), FloatType) else "<f8"
    found = usable(vectors, key, column, 1).withColumn("query", F.coalesce(is_query, F.lit(False)))
    width = found.agg(F.max(F.size("v")).alias("width")).first()["width"]
    if not width:
        return spark.createDataFrame([], schema)
    rows = kept(_packed(found, width, kind), "vectors")
    about = rows.agg(F.count("*").alias("n"), F.max("norm").alias("top"), F.count_if("query").alias("queries")).first()
    if not about["queries"]:
        return spark.createDataFrame([], schema)
    by_hash = [F.xxhash64("vec_id"), F.col("vec_id"), F.col("v")]
    asked = rows.where("query").orderBy(*by_hash).limit(o.pilots).collect()
    some = rows.orderBy(*by_hash).limit(o.sample).select("vec_id", "v").collect()
    pilots, sample = (np.stack([np.frombuffer(r["v"], dtype=kind) for r in part]).astype(np.float64) for part in (asked, some))
    near = _pilot_distance(rows, pilots, np.array([r["vec_id"] for r in asked]), np.array([r["norm"] for r in asked]), about["top"], width, kind, o)
    hashes = Hashes(near, about["top"], sample, about["n"], o)
    small = about["n"] <= 2 * o.cell
    every_table = 1 if small else o.tables

    def index(batches: Iterator[pa.RecordBatch], tables: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
        """Each batch's rows that can be results, with their buckets, for each of the first tables."""
        for batch in batches:
            ids, raw = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), dtype=object)
            _, own = np.unique(raw, return_inverse=True)
            order = np.lexsort((ids, own))
            same = own[order]
            new = np.r_[True, (same[1:] != same[:-1]) | (ids[order][1:] != ids[order][:-1])]  # an id with the same vector once
            order, same = order[new], same[new]
            nth = np.arange(len(same)) - np.searchsorted(same, same)
            batch = batch.take(pa.array(np.sort(order[nth <= o.k])))
            x = _rows(batch.column(1), width, kind)
            grown = hashes.grown(x, batch.column(2).to_numpy())
            for t in range(tables):
                yield batch, t, np.zeros(len(x), np.int64) if small else hashes.bucket(hashes.slots(t, grown))

    def visits(q: np.ndarray, norm: np.ndarray, tables: int, enough: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for t in range(tables):
            if small:
                yield t, np.arange(len(q)), np.zeros(len(q), np.int64)
            else:
                for at, buckets in hashes.probes(t, q, norm, enough):
                    yield t, at, buckets

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t, bucket in index(batches, every_table):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), t, np.int32)), pa.array(bucket), pa.array(np.full(len(bucket), 1, np.int64)), pa.array(np.zeros(len(bucket), np.int64))], names=["tab", "bucket", "n", "asked"])

    def asked_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, at, bucket in visits(_rows(batch.column(1), width, kind), batch.column(2).to_numpy(), every_table, hashes.enough):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(bucket), pa.array(np.zeros(len(at), np.int64)), pa.array(np.full(len(at), 1, np.int64))], names=["tab", "bucket", "n", "asked"])

    # Buckets of a table are dealt to groups of about half a block; one with more rows than a block is a group of its own.
    # Groups beyond a block on either side are dealt to several tasks; of a large table no more than o.listed can be that large.
    tagged = "tab int, bucket long, n long, asked long"
    sizes = rows.select("vec_id", "v", "norm").mapInArrow(X.tidied(keys), tagged).unionAll(rows.where("query").select("vec_id", "v", "norm").mapInArrow(X.tidied(asked_keys), tagged))
    sizes = kept(sizes.groupBy("tab", "bucket").agg(F.sum("n").alias("n"), F.sum("asked").alias("asked")).where("n > 0 and asked > 0"), "buckets")
    visited = sizes.agg(F.sum("n").alias("n"), F.sum("asked").alias("asked")).first()
    block = max(o.block, -(-3 * max(visited["n"] or 0, visited["asked"] or 0) // o.listed))
    groups = max(1, -(-2 * about["n"] // block))
    own = {t: np.array(sorted(r["bucket"] for r in some), dtype=np.int64) for t in range(o.tables) if (some := sizes.where((F.col("n") > block) & (F.col("tab") == t)).select("bucket").collect())}
    place = F.when(F.col("n") > block, F.col("bucket")).otherwise(F.pmod("bucket", F.lit(groups)))
    large = sizes.groupBy("tab", place.alias("grp")).agg(F.sum("n").alias("n"), F.sum("asked").alias("asked")).where((F.col("n") > block) | (F.col("asked") > block)).collect()
    parts = {(r["tab"], r["grp"]): (int(-(-r["asked"] // block)), int(-(-r["n"] // block))) for r in large}

    def dealt(t: int, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The group of each bucket, and into how many parts its queries and its rows are dealt."""
        group = bucket % groups
        if t in own:
            group = np.where(np.isin(bucket, own[t]), bucket, group)
        out, (values, place) = np.ones((len(bucket), 2), dtype=np.int64), np.unique(group, return_inverse=True)
        if parts:
            out = np.array([parts.get((t, int(g)), (1, 1)) for g in values], dtype=np.int64).reshape(-1, 2)[place]
        return group, out[:, 0], out[:, 1]

    def spread(ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (X.mix(ids.astype(np.uint64)) >> np.uint64(16)) % n.astype(np.uint64)

    def every(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row so many times, and which time it is."""
        at = np.repeat(np.arange(len(n)), n)
        return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)

    def sent(tables: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, t, bucket in index(batches, tables):
                group, n_parts, slots = dealt(t, bucket)
                slot = spread(batch.column(0).to_numpy(), slots)
                at, part = every(n_parts)
                columns = [pa.array(np.full(len(at), t, np.int32)), pa.array(group[at]), pa.array(part.astype(np.int32)), pa.array(slot[at].astype(np.int32)), *(c.take(pa.array(at)) for c in batch.columns[:2]), pa.array(bucket[at])]
                yield pa.RecordBatch.from_arrays(columns, names=["tab", "grp", "part", "slot", "vec_id", "v", "bucket"])

        return rows.select("vec_id", "v", "norm").mapInArrow(X.tidied(run), f"{where}, bucket long")

    def asking(queries: DataFrame, tables: int, enough: float) -> DataFrame:
        """queries: (vec_id, v, norm, least)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    some = batch.slice(lo, 512)
                    ids, q, least = some.column(0).to_numpy(), _rows(some.column(1), width, kind), some.column(3)
                    for t, at, bucket in visits(q, some.column(2).to_numpy(), tables, enough):
                        group, n_parts, slots = dealt(t, bucket)
                        order = np.lexsort((bucket, group, at))  # a query goes to a group once, with all its buckets there
                        at, bucket, group, n_parts, slots = (a[order] for a in (at, bucket, group, n_parts, slots))
                        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (group[1:] != group[:-1])]) if len(at) else np.zeros(0, np.int64)
                        lists = [bucket[a:b].tobytes() for a, b in zip(first, np.r_[first[1:], len(at)], strict=True)]
                        at, group, n_parts, slots = (a[first] for a in (at, group, n_parts, slots))
                        more, slot = every(slots)
                        part = spread(ids[at], n_parts)
                        rows_at = pa.array(at[more])
                        columns = [pa.array(np.full(len(more), t, np.int32)), pa.array(group[more]), pa.array(part[more].astype(np.int32)), pa.array(slot.astype(np.int32)), *(c.take(rows_at) for c in [*some.columns[:2], least]), pa.array(lists, type=pa.binary()).take(pa.array(more))]
                        yield pa.RecordBatch.from_arrays(columns, names=["tab", "grp", "part", "slot", "vec_id", "v", "least", "buckets"])

        return queries.mapInArrow(X.tidied(run), f"{where}, least double, buckets binary")

    where = "tab int, grp long, part int, slot int, vec_id long, v binary"

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        return _solve(left, right, width, kind, o.k)

    dealt_by = ["tab", "grp", "part", "slot"]
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(queries: DataFrame, tables: int, enough: float) -> DataFrame:
        met = asking(queries, tables, enough).groupBy(*dealt_by).cogroup(sent(tables).groupBy(*dealt_by)).applyInArrow(solve, "query_id long, vec_id long, score double")
        once = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= o.k)

    asked_rows = rows.where("query").select("vec_id", "v", "norm")
    none = F.lit(float("-inf"))
    queries = asked_rows.withColumn("least", none)
    if not small:
        bounds = kept(best(queries, 1, o.first).where(F.col("rank") == o.k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least")), "bounds")
        queries = asked_rows.join(bounds, "vec_id", "left").withColumn("least", F.coalesce("least", none))
    return best(queries, every_table, hashes.enough).select("query_id", "rank", "vec_id", "score")
