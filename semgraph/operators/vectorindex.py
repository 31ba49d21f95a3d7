"""Nearest items by cosine through an index of coarse cells (SNK-11, VEC-01, VEC-06).

Unit vectors go to the nearest of a bounded number of centres, drawn by hash.
With a cell's widest angle from its centre, all cosines between a query and its
items lie between two bounds.  Cells in the order of their lower bounds give,
once they hold k items, a cosine that the k-th best can't be below; only cells
whose upper bound reaches it are joined, by equality, so results are exact.

A search deals the cells to a bounded number of packs.  Each pack's items lie in
one task, the queries that need one of its cells stream past them, and scores are
products of blocks, of which only the k best of a query and pack are sent on.
Vectors are sent and stored as bytes, as they would else go entry by entry.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The most cells of an index; the driver and tasks hold their centres and bounds.
CELLS = 256
#: Items of a cell that one task should compare; larger cells are dealt to several.
SLOT = 20_000
#: Packs of a search (or two a core, if those are fewer) while they have at most PACK items each, beyond that as many as need be; the fewest items of one worth a task.
PACKS, PACK, FEWEST = 48, 131_072, 4_096
#: Scores that a task holds at once, and of how many items; the share of a pack's items from which all are multiplied at once.
SCORES, TILE, WHOLE = 2_000_000, 8_192, 0.5
#: What a bound gives way for rounding of scores to six digits.
SLACK = 2e-6


def doubles(v: Column | str) -> Column:
    return (F.col(v) if isinstance(v, str) else v).cast("array<double>")


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def _usable(df: DataFrame, width: int) -> DataFrame:
    """Rows whose vector has ``width`` entries, none null or not finite, and a length, as ``_v`` (floats stay floats) and ``_n``."""
    single = df.schema["vector"].dataType == T.ArrayType(T.FloatType(), df.schema["vector"].dataType.containsNull)
    some = df.withColumn("_v", F.col("vector") if single else doubles("vector")).where((F.size("_v") == width) & F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return some.select("*", F.explode(F.array(F.sqrt(dot(doubles("_v"), doubles("_v"))))).alias("_n")).where("_n > 0").drop("vector")


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """A batch's vectors, which are lists in _v or bytes in _b, as they are."""
    if "_v" in batch.schema.names:
        return batch.column(batch.schema.get_field_index("_v")).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    whole = b"".join(batch.column(batch.schema.get_field_index("_b")).to_pylist())
    return np.frombuffer(whole, dtype="<f4" if len(whole) == 4 * width * batch.num_rows else "<f8").reshape(-1, width)


def _bytes(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in x], pa.binary())


def _numbers(x: np.ndarray) -> Column:
    """Whole numbers as one literal, so that the driver makes no expression for each."""
    return F.split(F.lit(",".join(map(str, x.tolist()))), ",").cast("array<int>")


def _units(batch: pa.RecordBatch, width: int) -> np.ndarray:
    x = _matrix(batch, width).astype(np.float64)
    return x / np.linalg.norm(x, axis=1)[:, None]


@dataclass(frozen=True)
class VectorIndex:
    """packed (id, more columns, _b, _n, _cell, _slot); centres; of each cell its number, items and smallest cosine to the centre; if entries are floats."""

    packed: DataFrame | None
    centres: np.ndarray
    cells: list[tuple[int, int, float]]
    single: bool = False

    @property
    def width(self) -> int:
        return self.centres.shape[1] if len(self.centres) else 0

    @property
    def items(self) -> DataFrame:
        """``packed`` with the vectors as arrays, _v."""
        width, at = max(self.width, 1), self.packed.columns.index("_b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch, width)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(x.ravel()))
                yield batch.set_column(at, "_v", lists)

        fields = list(self.packed.schema.fields)
        fields[at] = T.StructField("_v", T.ArrayType(T.FloatType() if self.single else T.DoubleType()))
        return self.packed.mapInArrow(run, T.StructType(fields))

    def write(self, folder: str) -> None:
        """Stores the index, a file of items for each task, in the order of cells: a file for each cell and task would take longer than the search."""
        self.packed.sortWithinPartitions("_cell").write.parquet(f"{folder}/items")
        spark = self.packed.sparkSession
        rows = [{"cell": c, "n": n, "low": low, "centre": self.centres[c].tolist(), "single": self.single} for c, n, low in self.cells]
        shape = pa.schema({"cell": pa.int32(), "n": pa.int64(), "low": pa.float64(), "centre": pa.list_(pa.float64()), "single": pa.bool_()})
        # As a table of Arrow's, which needs no Python workers.
        spark.createDataFrame(pa.Table.from_pylist(rows, schema=shape)).coalesce(1).write.parquet(f"{folder}/cells")

    @staticmethod
    def read(spark: SparkSession, folder: str) -> VectorIndex:
        cells = spark.read.parquet(f"{folder}/cells").collect()
        centres = np.zeros((max((r["cell"] for r in cells), default=-1) + 1, max((len(r["centre"]) for r in cells), default=0)))
        for r in cells:
            centres[r["cell"]] = r["centre"]
        return VectorIndex(spark.read.parquet(f"{folder}/items"), centres, [(r["cell"], r["n"], r["low"]) for r in cells], any(r["single"] for r in cells))

    def _slots(self) -> np.ndarray:
        out = np.ones(len(self.centres), dtype=np.int64)
        for c, n, _ in self.cells:
            out[c] = max(1, -(-n // SLOT))
        return out

    def _reached(self, batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a batch with _v, and the places in ``cells`` of those that may hold one of the row's k best."""
        sizes = np.array([r[1] for r in self.cells], dtype=np.int64)
        wide, centres = np.arccos(np.clip([r[2] for r in self.cells], -1, 1)), self.centres[[r[0] for r in self.cells]]
        angle = np.arccos(np.clip(_units(batch, self.width) @ centres.T, -1, 1))
        far, near = np.minimum(angle + wide, np.pi), np.maximum(angle - wide, 0)
        order = np.argsort(far, axis=1)
        enough = np.cumsum(sizes[order], axis=1) > k  # one of them may be the query itself
        nth = np.where(enough.any(axis=1), enough.argmax(axis=1), len(sizes) - 1)
        reach = np.where(enough.any(axis=1), np.take_along_axis(far, np.take_along_axis(order, nth[:, None], axis=1), axis=1)[:, 0], np.pi)
        return np.nonzero(np.cos(near) >= np.cos(reach)[:, None] - SLACK)

    def _bare(self) -> VectorIndex:
        """The index without its items, for tasks."""
        return VectorIndex(None, self.centres, self.cells, self.single)

    def visits(self, queries: DataFrame, k: int) -> DataFrame:
        """``queries`` (with _v) once for each cell that may hold one of the k best and each of its slots, as _cell and _slot."""
        numbers, slots, index = np.array([r[0] for r in self.cells], dtype=np.int64), self._slots(), self._bare()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, place = index._reached(batch, k)
                times = slots[numbers[place]]
                more = np.repeat(np.arange(len(at)), times)
                slot = np.arange(len(more)) - np.repeat(np.cumsum(times) - times, times)
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at[more])) for c in batch.columns), pa.array(numbers[place[more]].astype(np.int32)), pa.array(slot.astype(np.int32))], names=[*batch.schema.names, "_cell", "_slot"])

        return queries.mapInArrow(run, T.StructType([*queries.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_slot", T.IntegerType())]))

    def packs(self, tasks: int = PACKS) -> dict[tuple[int, int], int]:
        """The pack of each cell and slot: consecutive ones, so that a pack has about as many items as any other; a query goes to each once, so they are no more than keep ``tasks`` busy."""
        most = min(max(-(-sum(n for _, n, _ in self.cells) // min(tasks, PACKS)), FEWEST), PACK)
        slots, seen, out = self._slots(), 0.0, {}
        for c, n, _ in sorted(self.cells):
            for slot in range(slots[c]):
                out[c, slot] = int((seen + n / slots[c] / 2) // most)
                seen += n / slots[c]
        return out

    def _asking(self, queries: DataFrame, k: int, packs: dict[tuple[int, int], int]) -> DataFrame:
        """``queries`` (question_id, _v) once for each pack that they need, as _pack, with the vector's bytes and the cells needed there, as _cells."""
        index, width = self._bare(), self.width
        numbers, count = np.array([r[0] for r in self.cells], dtype=np.int32), max(packs.values()) + 1
        holds = np.zeros((len(self.cells), count), dtype=bool)
        for (c, _), pack in packs.items():
            holds[numbers == c, pack] = True

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for lo in range(0, whole.num_rows, 256):
                    batch = whole.slice(lo, 256)
                    at, place = index._reached(batch, k)
                    pair, pack = np.nonzero(holds[place])
                    order = np.lexsort((pack, at[pair]))
                    key, cell = at[pair][order] * count + pack[order], numbers[place[pair][order]]
                    key, first = np.unique(key, return_index=True)
                    cells = pa.ListArray.from_arrays(pa.array(np.append(first, len(cell)).astype(np.int32)), pa.array(cell))
                    some = batch.column(0), _bytes(_matrix(batch, width))
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(key // count)) for c in some), pa.array((key % count).astype(np.int32)), cells], names=["question_id", "_b", "_pack", "_cells"])

        fields = [queries.schema["question_id"], T.StructField("_b", T.BinaryType()), T.StructField("_pack", T.IntegerType()), T.StructField("_cells", T.ArrayType(T.IntegerType()))]
        return queries.select("question_id", "_v").mapInArrow(run, T.StructType(fields))


def build(items: DataFrame, width: int | None = None) -> VectorIndex:
    """The index of (id, vector, more columns).

    Items without a usable vector (null, zero, of another size than ``width``, by
    default the longest's, or with entries that are null or not finite) are not in it.
    """
    # Centres are as many as cells of about 64 items, at most CELLS; equal vectors are one centre.
    most, guessed = min(CELLS, -(-items.count() // 64)), width is None
    sized = items.where(F.size("vector") > 0 if guessed else F.size("vector") == max(width, 1))
    order = F.xxhash64("id"), F.col("id")
    drawn = [[np.nan if c is None else c for c in r["vector"]] for r in sized.orderBy(*order).limit(most).select("vector").collect()]
    if guessed:
        width = max(map(len, drawn), default=0)  # the pass over all rows tells if others are longer
        sized = items.where(F.size("vector") == max(width, 1))
    chosen = [v for v in drawn if len(v) == width and np.isfinite(v).all() and np.linalg.norm(v) > 0]
    # Rows whose vector is of no use are seldom drawn alone; then others are.
    if drawn and not chosen:
        width = items.agg(F.max(F.size("vector")).alias("w")).first()["w"] if guessed else width
        guessed, sized = False, items.where(F.size("vector") == width)
        chosen = [r["_v"] for r in _usable(sized, width).orderBy(*order).limit(most).select("_v").collect()]
    x = np.array(chosen, dtype=np.float64).reshape(-1, max(width, 1))
    centres = np.unique(x / np.linalg.norm(x, axis=1)[:, None], axis=0)
    kind = _usable(items.limit(0), max(width, 1)).schema["_v"].dataType
    single = kind.elementType == T.FloatType()
    more = [c for c in items.columns if c != "vector"]
    shape = T.StructType([*(items.schema[c] for c in more), T.StructField("_b", T.BinaryType()), T.StructField("_n", T.DoubleType()), T.StructField("_cell", T.IntegerType())])

    def nearest(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which rows are usable; of those the length, the cell and the cosine to its centre."""
        x = _matrix(batch, width).astype(np.float64)
        norm = np.linalg.norm(x, axis=1)
        good = np.isfinite(x).all(axis=1) & (norm > 0)
        cosines = (x[good] / norm[good][:, None]) @ centres.T
        cell = cosines.argmax(axis=1)
        return good, norm[good], cell.astype(np.int32), cosines[np.arange(len(cell)), cell]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, norm, cell, _ = nearest(batch)
            some = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([*(some.column(some.schema.get_field_index(c)) for c in more), _bytes(_matrix(some, width)), pa.array(norm), pa.array(cell)], names=shape.names)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each cell of a task, so that no vectors come back; the last cell counts the vectors that are too long."""
        n, low = np.zeros(len(centres) + 1, dtype=np.int64), np.full(len(centres) + 1, np.inf)
        for batch in batches:
            long = batch.column(batch.schema.get_field_index("_long")).to_numpy(zero_copy_only=False)
            n[-1] += long.sum()
            _, _, cell, cosine = nearest(batch.filter(pa.array(~long)))
            n += np.bincount(cell, minlength=len(n))
            np.minimum.at(low, cell, cosine)
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(n[there]), pa.array(low[there])], names=["_cell", "n", "low"])

    if not len(centres):
        return VectorIndex(items.sparkSession.createDataFrame([], T.StructType([*shape.fields, T.StructField("_slot", T.IntegerType())])), centres, [], single)
    # As _usable() does, in blocks.
    as_v, size = F.col("vector").cast(kind), F.size("vector")
    each = (items.where(size >= width) if guessed else sized).select(F.when(size == width, as_v).alias("_v"), (size > width).alias("_long")).mapInArrow(counted, "_cell int, n long, low double")
    cells = [(r["_cell"], r["n"], r["low"]) for r in each.groupBy("_cell").agg(F.sum("n").alias("n"), F.min("low").alias("low")).collect()]
    if any(c == len(centres) for c, *_ in cells):
        return build(items, items.agg(F.max(size).alias("w")).first()["w"])
    celled = sized.select(*more, as_v.alias("_v")).mapInArrow(run, shape)
    index = VectorIndex(None, centres, cells, single)
    return VectorIndex(celled.withColumn("_slot", F.pmod(F.xxhash64("id"), F.get(_numbers(index._slots()), "_cell")).cast("int")), centres, cells, single)


def topk(queries: DataFrame, index: VectorIndex, k: int, apart: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(question_id, id, score, rank): the k items of the largest cosine, rounded to six digits, ties to the smaller id.

    queries: (question_id, vector); those without a usable vector get no rows.
    apart: an item whose id is the query's is none of its own.
    keep: the items' columns that are returned as well, so that they need not be joined on.
    """
    if not index.cells:
        return queries.select("question_id").limit(0).crossJoin(index.packed.select("id", *keep).limit(0)).select("question_id", "id", F.lit(0.0).alias("score"), F.lit(1).alias("rank"), *keep)
    packs, width, held = index.packs(2 * queries.sparkSession.sparkContext.defaultParallelism), index.width, index.packed.schema
    asked = index._asking(_usable(queries.select("question_id", "vector"), width), k, packs)
    # Cells' numbers and slots count up, so the packs are one array (of at most CELLS entries, and one for each further slot), and each cell has a place where it begins.
    slots = index._slots()
    first = np.cumsum(slots) - slots
    of = np.zeros(int(slots.sum()), dtype=np.int64)
    for (c, slot), pack in packs.items():
        of[first[c] + slot] = pack
    pack = F.get(_numbers(of), F.get(_numbers(first), "_cell") + F.col("_slot")).alias("_pack")
    items = index.packed.select(pack, F.lit(0).alias("_side"), "id", F.lit(None).cast(asked.schema["question_id"].dataType).alias("question_id"), "_b", F.array("_cell").alias("_cells"), *keep)
    own = F.col("question_id").cast(held["id"].dataType) if apart else F.lit(None).cast(held["id"].dataType)
    asked = asked.select("_pack", F.lit(1).alias("_side"), own.alias("id"), "question_id", "_b", "_cells", *(F.lit(None).cast(held[c].dataType).alias(c) for c in keep))
    # A partition is a pack; hashed, some would have several and others none.
    dealt = items.unionAll(asked).repartitionById(max(packs.values()) + 1, F.col("_pack")).sortWithinPartitions("_pack", "_side", "id")
    shape = T.StructType([asked.schema["question_id"], T.StructField("id", held["id"].dataType), T.StructField("score", T.DoubleType()), *(held[c] for c in keep)])
    met = dealt.mapInArrow(lambda batches: _searched(batches, width, k, keep), shape)
    return best(met.where(F.col("question_id") != F.col("id")) if apart else met, k).select("question_id", "id", "score", "rank", *keep)


class _Pack:
    """The items of a pack, by cell and within a cell by id."""

    def __init__(self, parts: list[pa.RecordBatch], width: int, keep: tuple[str, ...] = ()):
        self.ids, self.more = pa.concat_arrays([p.column("id") for p in parts]), {c: pa.concat_arrays([p.column(c) for p in parts]) for c in keep}
        cell = np.concatenate([p.column("_cells").flatten().to_numpy() for p in parts])
        self.place = np.argsort(cell, kind="stable")  # rows come by id, so a smaller place is a smaller id
        self.vectors = np.concatenate([_matrix(p, width) for p in parts])[self.place]
        self.near = np.concatenate([_units(p, width).astype(np.float32) for p in parts])[self.place]
        # What a product of unit vectors in single precision can be off by.
        self.off = (width + 4) * 2.0**-23
        cells, first = np.unique(cell[self.place], return_index=True)
        self.spans = dict(zip(cells.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(cell)], strict=True), strict=True))
        self.at: dict | None = None

    def own(self, me: list) -> np.ndarray:
        """(row, item) of the queries' own items."""
        if all(m is None for m in me):
            return np.empty((0, 2), dtype=np.int64)
        if self.at is None:
            spot = np.empty(len(self.place), dtype=np.int64)
            spot[self.place] = np.arange(len(self.place))
            self.at = {}
            for i, x in zip(spot.tolist(), self.ids.to_pylist(), strict=True):
                self.at.setdefault(x, []).append(i)
        return np.array([(r, i) for r, m in enumerate(me) if m is not None for i in self.at.get(m, ())], dtype=np.int64).reshape(-1, 2)

    def _tiles(self, row: np.ndarray, cell: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, int, int]]:
        """Rows of the queries and stretches of items to multiply: all with all (what isn't needed does no harm) if most is needed, else cell by cell."""
        n, every = len(self.place), np.arange(rows)
        sizes = {c: last - first for c, (first, last) in self.spans.items()}
        if sum(sizes.get(c, 0) * m for c, m in zip(*(x.tolist() for x in np.unique(cell, return_counts=True)), strict=True)) >= WHOLE * n * rows:
            spans = [(every, 0, n)]
        else:
            spans = [(row[cell == c], *span) for c, span in self.spans.items()]
        for some, first, last in spans:
            for at in range(first, last if len(some) else first, TILE):
                yield some, at, min(at + TILE, last)

    def _exact(self, unit: np.ndarray, at: np.ndarray, i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best items of each row, in double precision: row, item, score."""
        found = np.empty(len(at))
        for first in range(0, len(at), step := max(1, SCORES // unit.shape[1])):
            of = slice(first, first + step)
            x = self.vectors[i[of]].astype(np.float64)
            found[of] = np.einsum("ij,ij->i", unit[at[of]], x / np.linalg.norm(x, axis=1)[:, None])
        found = np.copysign(np.floor(np.abs(found) * 1e6 + 0.5), found) / 1e6 + 0.0
        order = np.lexsort((self.place[i], -found, at))
        nth = np.arange(len(at)) - np.searchsorted(at[order], at[order])
        order = order[nth < k]
        return at[order], i[order], found[order]

    def answers(self, asked: pa.RecordBatch, width: int, k: int) -> Iterator[pa.RecordBatch]:
        """A first look in single precision finds what can be among the k best; its scores are made in double precision."""
        for lo in range(0, asked.num_rows, step := max(1, SCORES // min(TILE, len(self.place)))):
            some = asked.slice(lo, step)
            unit, lists = _units(some, width), some.column("_cells")
            at, i, found = self._looked(unit, np.repeat(np.arange(len(unit)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy(), self.own(some.column("id").to_pylist()), k)
            at, i = pa.array(at), pa.array(self.place[i])
            yield pa.RecordBatch.from_arrays([some.column("question_id").take(at), self.ids.take(i), pa.array(found), *(c.take(i) for c in self.more.values())], names=["question_id", "id", "score", *self.more])

    def _looked(self, unit: np.ndarray, row: np.ndarray, cell: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        single, spot = unit.astype(np.float32), np.empty(len(unit), dtype=np.int64)
        top = np.full((len(unit), k), -np.inf, dtype=np.float32)  # k scores of each row, the smallest first: its k-th best can't be below that
        bound = lambda rows: top[rows, 0].astype(np.float64) - SLACK - 2 * self.off
        seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.float32))]
        held = 0
        for rows, first, last in self._tiles(row, cell, len(unit)):
            score = (single if len(rows) == len(unit) else single[rows]) @ self.near[first:last].T
            if len(mine := own[(own[:, 1] >= first) & (own[:, 1] < last)]):
                spot[:] = -1
                spot[rows] = np.arange(len(rows))
                mine = mine[spot[mine[:, 0]] >= 0]
                score[spot[mine[:, 0]], mine[:, 1] - first] = -np.inf
            # Of each group of items, one of every stretch, the largest score; what is left over are groups of one.
            stretch = min(64, max(1, (last - first) // (4 * k)))
            groups = (last - first) // stretch
            blocks, rest = score[:, : stretch * groups].reshape(len(rows), stretch, groups), score[:, stretch * groups :]
            most = np.concatenate([blocks.max(axis=1), rest], axis=1)
            top[rows] = np.partition(np.concatenate([top[rows], most], axis=1), -k, axis=1)[:, -k:]
            least = bound(rows)
            at, group = np.nonzero((most >= least[:, None]) & (most > -np.inf))
            in_block = group < groups
            close = blocks[at[in_block], :, group[in_block]]
            pair, nth = np.nonzero((close >= least[at[in_block], None]) & (close > -np.inf))
            alone = ~in_block
            at, i = np.concatenate([at[in_block][pair], at[alone]]), np.concatenate([nth * groups + group[in_block][pair], stretch * groups + group[alone] - groups])
            seen.append((rows[at], first + i, score[at, i]))
            held += len(at)
            if held > SCORES // 8:  # many equal ones: only the k best of them are kept
                seen = [self._settled(unit, seen, bound, k)]
                held = len(seen[0][0])
        at, i, _ = self._settled(unit, seen, bound, k)
        return self._exact(unit, at, i, k)

    def _settled(self, unit: np.ndarray, seen: list, bound: Callable, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of what was seen what can still be among the k best; if that is much, what is."""
        at, i, score = (np.concatenate(x) for x in zip(*seen, strict=True))
        can = score >= bound(at)
        at, i, score = at[can], i[can], score[can]
        if len(at) > SCORES // 16:
            at, i, score = self._exact(unit, at, i, k)
            score = np.full(len(at), np.inf, dtype=np.float32)
        return at, i, score


def _searched(batches: Iterator[pa.RecordBatch], width: int, k: int, keep: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
    """The k best of each query in each pack; of a pack the items come first, by id, and then its queries."""
    number, parts, pack = None, [], None
    for batch in batches:
        key = 2 * batch.column("_pack").to_numpy().astype(np.int64) + batch.column("_side").to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), batch.num_rows]
        for first, last in zip(bounds, bounds[1:]):  # noqa: B905, RUF007
            if first == last:
                continue
            some, (of, side) = batch.slice(first, last - first), divmod(int(key[first]), 2)
            if of != number:
                number, parts, pack = of, [], None
            if side == 0:
                parts.append(some)
            elif parts or pack:
                pack, parts = pack or _Pack(parts, width, keep), []
                yield from pack.answers(some, width, k)


def within(queries: DataFrame, items: DataFrame, columns: list[str], k: int, apart: bool = False) -> DataFrame:
    """VEC-06: as topk(), among the items that agree with the query in ``columns``; common values are dealt to several tasks."""
    width = queries.agg(F.max(F.size("vector")).alias("w")).first()["w"] or 1
    own = _usable(items.select("id", "vector", *columns), width).withColumn("_v", doubles("_v"))
    slots = own.groupBy(*columns).agg(F.ceil(F.count("*") / SLOT).cast("int").alias("_slots"))
    asked = _usable(queries.select("question_id", "vector", *columns), width).select("question_id", doubles("_v").alias("_q"), F.col("_n").alias("_m"), *columns)
    asked = asked.join(slots, columns).withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1))).drop("_slots")
    dealt = own.join(slots, columns).withColumn("_slot", F.pmod(F.xxhash64("id"), F.col("_slots")).cast("int")).drop("_slots")
    met = asked.join(dealt, [*columns, "_slot"])
    return ranked(met.where(F.col("question_id") != F.col("id")) if apart else met, k)


def ranked(met: DataFrame, k: int) -> DataFrame:
    """The k best of (question_id, _q, _m, id, _v, _n); each task keeps the best of its own rows before any are shuffled."""
    return best(met.select("question_id", "id", F.round(dot(F.col("_q"), F.col("_v")) / (F.col("_m") * F.col("_n")), 6).alias("score")), k)


def best(scored: DataFrame, k: int) -> DataFrame:
    """The k best of (question_id, id, score), with their rank."""
    order = Window.partitionBy("question_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
