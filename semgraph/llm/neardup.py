"""MinHash near-dedup with sequential Bayesian verification.

1. One pass over the texts makes, for each document, its set size, a digest of
   its set, band keys of its MinHash signature, and one byte of each signature
   place.  Documents of one digest are one *class*, named by one of its rows.
2. Classes that share a band key are candidates.  No bucket's pairs are listed.
   In each of a few rounds a class is compared with one leader of its bucket
   alone (the smallest, then random ones), and only where the two are not yet
   in one component; a large group of copies is settled by as many comparisons
   as it has members.
3. What is still in different components within a bucket is compared in blocks,
   signature against signature, inside the tasks.  Each block gives a forest
   that spans what may be linked, and the forests' components are *clusters*.
4. Within a cluster, slot by slot, remaining pairs are verified on full sets in
   memory; a block gives the links that join components, at most one a member.
5. Components of all verified links give the result.

A comparison reads the signature in batches.  With a uniform prior, the
posterior of the similarity after m matches of n is Beta(m + 1, n - m + 1); a
pair is dropped once the posterior chance of reaching the threshold falls below
``miss``.  Every link is verified on the full sets.  With 32 bands of 5 a pair
at similarity 0.85 shares no band in 7e-9 of cases.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .components import components
from .tables import drop_kept, kept


@dataclass(frozen=True)
class NearDup:
    """shingle: words; a link needs 100 * intersection >= percent * union; turns: rounds with one leader a bucket; block, block_shingles: most members and about the most set members compared in one slot; file_rows: documents to a file of what is kept about them."""

    shingle: int = 5
    percent: int = 85
    bands: int = 32
    rows: int = 5
    batch: int = 32
    miss: float = 1e-7
    turns: int = 2
    block: int = 256
    block_shingles: int = 1_000_000
    file_rows: int = 10_000
    seed: int = 11

    @property
    def places(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=4)
def _functions(p: NearDup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(p.seed)
    a = rng.integers(0, 2**31, p.places, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 2**32, p.places, dtype=np.uint32)
    return a[:, None], b[:, None], X.mix(np.arange(p.bands, dtype=np.uint64) + np.uint64(p.seed))


@lru_cache(maxsize=4)
def least_matches(p: NearDup) -> tuple[tuple[int, int], ...]:
    """(places read, least matches to go on): P(similarity >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    t, found = p.percent / 100, []
    for n in [*range(p.batch, p.places, p.batch), p.places]:
        total, m = 0.0, -1
        while total < p.miss and m < n:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        found.append((n, m))
    return tuple(found)


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of one step."""
    words = X.Words(*X.flat(column), lower=True)
    hashes = words.hashes()
    keys, first = X.windows(hashes, words.bounds, n)
    at = np.searchsorted(first, words.bounds)
    for r in range(len(column)):
        lo, count = words.bounds[r], words.counts[r]
        if 0 < count < n:
            yield X.run_hash(hashes, lo[None], count) ^ np.uint64(count)
        else:
            yield np.unique(keys[at[r] : at[r + 1]])


def signature(members: np.ndarray, p: NearDup) -> np.ndarray:
    """MinHash over 32 bits of each member."""
    a, b, _ = _functions(p)
    x = (members >> np.uint64(32)).astype(np.uint32)
    out = np.full(p.places, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(x), 1024):
        np.minimum(out, (a * x[None, lo : lo + 1024] + b).min(axis=1), out=out)
    return out


def sketch(docs: DataFrame, p: NearDup, key: str, text: str) -> DataFrame:
    """(doc_id, text_hash, uid, n_shingles, digest, bands, sig); the last three are null for an empty set.  uid: a number of the row's own."""
    schema = "doc_id long, text_hash long, uid long, n_shingles long, digest binary, bands array<long>, sig binary"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, task, made = _functions(p)[2], TaskContext.get().partitionId(), 0
        for batch in batches:
            column = X.texts(batch.column(2))
            for lo, hi in X.steps(column):
                rows: list[tuple] = []
                for members in shingle_sets(column.slice(lo, hi - lo), p.shingle):
                    if not len(members):
                        rows.append((0, None, None, None))
                        continue
                    sig = signature(members, p)
                    bands = X.run_hash(X.mix(sig.astype(np.uint64)), np.arange(0, p.places, p.rows), p.rows) ^ salt
                    rows.append((len(members), _digest(members), X.mix(bands).view(np.int64), X.mix(sig.astype(np.uint64)).astype(np.uint8).tobytes()))
                uid = pa.array((task << 40) + np.arange(made, made + hi - lo))
                made += hi - lo
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), uid, *(pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds[3:], strict=True))], names=names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")).mapInArrow(X.tidied(run), schema)


def _digest(members: np.ndarray) -> bytes:
    return blake2b(members.tobytes(), digest_size=16).digest()


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of one length as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


def survivors(left: np.ndarray, right: np.ndarray, p: NearDup) -> np.ndarray:
    """Which pairs of signature rows are still possible links after all batches."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), dtype=np.int64), 0
    for n, least in least_matches(p):
        matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        going = matches >= least
        alive, matches, done = alive[going], matches[going], n
    return alive


def _pass_signatures(pairs: DataFrame, sigs: DataFrame, p: NearDup) -> DataFrame:
    """The pairs (a, b) that sequential comparison of their signatures doesn't drop."""
    both = pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a").join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                go = survivors(matrix(batch.column(2), p.places), matrix(batch.column(3), p.places), p)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(go)), batch.column(1).take(pa.array(go))], names=["a", "b"])

    return both.mapInArrow(X.tidied(run), "a long, b long")


def _streamed(found, keys: int):
    """A mapInArrow function that gives ``found`` whole groups: rows come sorted by their first ``keys`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in range(keys)]
            ends = np.flatnonzero(np.any([c != c[-1] for c in columns], axis=0))
            cut = int(ends[-1]) + 1 if len(ends) else 0
            new = bool(rest) and any(rest[-1].column(c)[0].as_py() != columns[c][0] for c in range(keys))
            if cut or new:
                yield from found(pa.Table.from_batches([*rest, batch.slice(0, cut)]))
                rest = []
            rest.append(batch.slice(cut))
        if rest:
            yield from found(pa.Table.from_batches(rest))

    return run


def _close(table: pa.Table, p: NearDup) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one group, of different labels, that pass the signatures.

    Columns: three keys (the last two the slots that meet), slot, rep, label, sig.
    Pairs of one slot are met where it meets itself.
    """
    band, i, j, slot, _, label = (table.column(c).to_numpy() for c in range(6))
    sig = matrix(table.column(6).combine_chunks(), p.places)
    group = np.cumsum(np.r_[True, (band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    a, b, reach = [], [], 1
    while reach < len(group):
        at = np.flatnonzero(group[reach:] == group[:-reach])
        if not len(at):
            break
        at = at[(label[at] != label[at + reach]) & ((slot[at] != slot[at + reach]) | (i[at] == j[at]))]
        at = at[survivors(sig[at], sig[at + reach], p)] if len(at) else at
        a.append(at)
        b.append(at + reach)
        reach += 1
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))


class _Union(dict):
    """Disjoint sets of numbers."""

    def find(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self[x] = y
        return x != y


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([min(x) for x in links], type=pa.int64()), pa.array([max(x) for x in links], type=pa.int64())], names=["a", "b"])


def _dealt(rows: DataFrame, weight: Column, p: NearDup) -> DataFrame:
    """rows (grp, rep, label, ...) of groups with several labels, once for each pair of slots (i, j) that they take part in.

    The members of a group's largest label lie in slots of their own, below 0.
    They meet the other members but not each other, so a large settled group
    costs what its few strangers make necessary.
    """
    by_label = rows.groupBy("grp", "label").agg(F.count("*").alias("n"), F.sum(weight).alias("w"))
    whole = by_label.groupBy("grp").agg(F.max(F.struct("n", "label", "w")).alias("m"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.count("*").alias("labels")).where("labels > 1")

    def slots(n: Column, w: Column) -> Column:
        return F.greatest(F.ceil(n / p.block), F.ceil(w / p.block_shingles)).cast("int")

    sizes = whole.select(F.col("grp").alias("g"), F.col("m.label").alias("main"), slots(F.col("m.n"), F.col("m.w")).alias("a"), slots(F.col("n") - F.col("m.n"), F.col("w") - F.col("m.w")).alias("b"))
    h = F.xxhash64("rep", F.lit(p.seed))
    settled = F.col("label") == F.col("main")
    rows = rows.join(sizes, F.col("grp") == F.col("g")).withColumn("slot", F.when(settled, -1 - F.pmod(h, F.col("a"))).otherwise(F.pmod(h, F.col("b"))).cast("int"))
    others = F.sequence(F.lit(0), F.col("b") - 1)
    rows = rows.withColumn("other", F.explode(F.when(settled, others).otherwise(F.concat(others, F.sequence(-F.col("a"), F.lit(-1))))))
    return rows.withColumns({"i": F.least("slot", "other"), "j": F.greatest("slot", "other")})


def _clusters(members: DataFrame, sigs: DataFrame, p: NearDup, files: int) -> DataFrame:
    """(node, label): what classes of different components and one bucket may be linked to, by signatures alone."""
    rows = _dealt(members.withColumnRenamed("band", "grp"), F.lit(0), p).select("grp", "i", "j", "slot", "rep", "label")
    rows = rows.join(sigs.select("rep", "sig"), "rep").select("grp", "i", "j", "slot", "rep", "label", "sig")

    def forest(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rep, seen = table.column(4).to_numpy(), _Union()
        a, b = _close(table, p)
        yield _pairs([(x, y) for x, y in zip(rep[a].tolist(), rep[b].tolist(), strict=True) if seen.join(x, y)])

    edges = rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j").mapInArrow(X.tidied(_streamed(forest, 3)), "a long, b long")
    return components(edges, files=files)


def _shared(ma: pa.Scalar, mb: pa.Scalar, p: NearDup) -> bool:
    """Whether two sorted sets of hashes are similar enough."""
    x, y = (np.frombuffer(m.as_buffer(), dtype=np.uint64) for m in (ma, mb))
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small):
        return False
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[place] == small).sum())
    return 100 * shared >= p.percent * (len(x) + len(y) - shared)


def _verified_clusters(clusters: DataFrame, labels: DataFrame, sigs: DataFrame, sets: DataFrame, p: NearDup) -> DataFrame:
    """Links, verified on full sets, that join different components within clusters."""
    rows = clusters.select(F.col("node").alias("rep"), F.col("label").alias("grp")).join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep")).join(sigs, "rep")
    rows = _dealt(rows, F.col("n_shingles"), p).select("grp", "i", "j", "slot", "rep", "label", "sig")
    rows = rows.join(sets, "rep").select("grp", "i", "j", "slot", "rep", "label", "sig", "members")

    def links(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rep, label, members = table.column(4).to_numpy(), table.column(5).to_numpy(), table.column(7).combine_chunks()
        seen, good = _Union(), []
        for x, y in zip(*(z.tolist() for z in _close(table, p)), strict=True):
            u, v = int(label[x]), int(label[y])
            if seen.find(u) != seen.find(v) and _shared(members[x], members[y], p):
                seen.join(u, v)
                good.append((int(rep[x]), int(rep[y])))
        yield _pairs(good)

    return rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j").mapInArrow(X.tidied(_streamed(links, 3)), "a long, b long").distinct()


def _sets(docs: DataFrame, sigs: DataFrame, p: NearDup, key: str, text: str) -> DataFrame:
    """(rep, members): the full set of each class, as sorted 64-bit hashes, from the row of its id that has its digest."""
    # Texts are shuffled once at every size; a small side that happens to fit a broadcast would only make growth uneven.
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).join(sigs.select("doc_id", "rep", "digest").hint("merge"), "doc_id").select("rep", "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = X.texts(batch.column(2))
            for lo, hi in X.steps(column):
                found = list(shingle_sets(column.slice(lo, hi - lo), p.shingle))
                own = pa.array([_digest(x) == d.as_py() for x, d in zip(found, batch.column(1).slice(lo, hi - lo), strict=True)], type=pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([x.tobytes() for x in found], type=pa.binary())], names=["rep", "members"]).filter(own)

    return texts.mapInArrow(X.tidied(run), "rep long, members binary")


def _verified(pairs: DataFrame, sets: DataFrame, p: NearDup) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("members").alias("ma")), "a").join(sets.select(F.col("rep").alias("b"), F.col("members").alias("mb")), "b").select("a", "b", "ma", "mb")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = pa.array([_shared(x, y, p) for x, y in zip(batch.column(2), batch.column(3), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    return both.mapInArrow(X.tidied(exact), "a long, b long").distinct()


def near_dup_rows(docs: DataFrame, p: NearDup | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, first) for every row of ``docs``.

    text_hash: xxhash64 of the text.  component_id: the smallest id that links
    lead to.  first: no row of the component has a smaller (doc_id, text_hash).
    Rows of one id and different texts are documents of their own; repeated
    rows each give a row.  A null or wordless text has an empty set and is
    linked with nothing, as is a row with a null id (its component is null).
    """
    p = p or NearDup()
    sketches = kept(sketch(docs, p, key, text), "sketches")
    # Tables of a few numbers a document are written as few files, in proportion to the documents.
    few = max(8, -(-sketches.count() // p.file_rows))
    classes = kept(sketches.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "text_hash", "uid")).alias("lead")), "classes", few)
    named = sketches.join(classes.select(F.col("lead.uid").alias("uid")), "uid", "left_semi").withColumnRenamed("uid", "rep")
    spots = named.select("rep", F.explode("bands").alias("band"))
    shared = spots.groupBy("band").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select(F.col("band").alias("k"))
    members = kept(spots.join(shared, F.col("band") == F.col("k")).select("band", "rep").distinct(), "members", few)
    ids = members.select("rep").distinct()
    sigs = kept(named.select("rep", "doc_id", "digest", "n_shingles", "sig").join(ids.hint("merge"), "rep", "left_semi"), "sigs", few)
    sets = kept(_sets(docs, sigs, p, key, text).dropDuplicates(["rep"]), "sets")

    labels = None
    for turn in range(p.turns):
        now = members.withColumn("label", F.col("rep")) if labels is None else members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        order = F.col("rep") if not turn else F.xxhash64("rep", F.lit(turn))
        leaders = now.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min_by(F.struct("rep", "label"), order).alias("leader")).where("lo <> hi").select(F.col("band").alias("k"), "leader")
        pairs = now.join(leaders, F.col("band") == F.col("k")).where("label <> leader.label").select(F.least("rep", "leader.rep").alias("a"), F.greatest("rep", "leader.rep").alias("b")).distinct()
        labels = _joined(labels, kept(_verified(_pass_signatures(pairs, sigs, p), sets, p), "links", few), few)

    now = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    clusters = _clusters(now, sigs, p, few)
    whole = _joined(labels, kept(_verified_clusters(clusters, labels, sigs, sets, p), "links", few), few).withColumnRenamed("node", "rep")
    drop_kept(members, sigs, sets, clusters)

    leads = classes.withColumn("rep", F.col("lead.uid")).join(whole, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    linked = whole.join(classes.select(F.col("lead.uid").alias("rep"), "lead"), "rep").groupBy("label").agg(F.min("lead").alias("best"))
    leads = leads.join(linked, "label", "left").select("digest", F.coalesce("best", "lead").alias("lead"))
    rows = sketches.select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(leads, "digest", "left")
    first = F.struct("doc_id", "text_hash") == F.struct(F.col("lead.doc_id").alias("doc_id"), F.col("lead.text_hash").alias("text_hash"))
    return rows.select("doc_id", "text_hash", "n_shingles", F.coalesce("lead.doc_id", "doc_id").alias("component_id"), (F.col("lead").isNull() | first).alias("first"))


def _joined(labels: DataFrame | None, links: DataFrame, files: int) -> DataFrame:
    """(node, label) of the components that earlier labels and new links make together; what they came from is removed."""
    edges = links if labels is None else links.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
    found = components(edges, files=files)
    drop_kept(links, *([] if labels is None else [labels]))
    return found


def near_dups(docs: DataFrame, p: NearDup | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; kept: doc_id is component_id, or null.  As near_dup_rows tells; other columns are not looked at."""
    rows = near_dup_rows(docs, p, key, text)
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
