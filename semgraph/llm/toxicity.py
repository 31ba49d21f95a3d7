"""Counterfactually regularised toxicity classifier.

Logistic regression on the words and word beginnings present in a text, fitted
with proximal AdaGrad and an L1 penalty, on a bounded sample of labelled rows.

Counterfactuals are made from the labelled sentences on the executors.  A text
that names a group is also read with the name swapped for others of its kind
and with the name left out.  Of the texts that name none, every
``mention_every``-th (by a hash) is read with a neutral sentence that mentions
a group inserted between its sentences; that version is a training row with
the text's label, and is itself swapped and compared with the text as it was.
The squared change of the score between a version and its counterfactual is
penalised, pair by pair, on the features that the two texts really have, so a
neutral mention of a group moves the score little.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops as X
from .tables import drop_kept, kept

#: Lengths in bytes of the word beginnings that are features.
PREFIXES = (4, 5, 6, 7, 8, 9, 10)

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SENTENCE = re.compile(r"[.!?]+(?=[\x20\x09-\x0D])")
_MARKS = "".join(chr(b) for b in range(0x21, 0x7F) if not chr(b).isalnum())
_ASCII_LOWER = {b: b + 32 for b in range(65, 91)}

_EDGE = np.zeros(256, dtype=bool)
_EDGE[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True



@dataclass(frozen=True)
class Group:
    """Terms that may stand for each other, and a neutral sentence that mentions one."""

    terms: tuple[str, ...]
    mention: str


_SENTENCES = {
    "en": "The {} neighbours came to visit.",
    "de": "Die Nachbarn ({}) kamen zu Besuch.",
    "es": "Los vecinos ({}) vinieron de visita.",
    "fr": "Les voisins ({}) sont venus en visite.",
}
#: Identity terms by language and kind: religion, gender, orientation, origin, condition.
_TERMS = {
    "en": (
        "christian muslim jewish hindu buddhist atheist sikh catholic",
        "woman man women men female male transgender nonbinary",
        "gay lesbian straight bisexual heterosexual homosexual queer",
        "black white asian african latino arab european immigrant foreigner",
        "blind deaf disabled autistic elderly young",
    ),
    "de": ("christen muslime juden hindus buddhisten atheisten katholiken", "frau mann frauen männer", "schwul lesbisch heterosexuell bisexuell", "schwarze weiße asiaten afrikaner araber europäer einwanderer ausländer", "blind taub behindert alt jung"),
    "es": ("cristianos musulmanes judíos hindúes budistas ateos católicos", "mujer hombre mujeres hombres", "gais lesbianas heterosexuales bisexuales", "negros blancos asiáticos africanos árabes europeos inmigrantes extranjeros", "ciegos sordos discapacitados ancianos jóvenes"),
    "fr": ("chrétiens musulmans juifs hindous bouddhistes athées catholiques", "femme homme femmes hommes", "gays lesbiennes hétérosexuels bisexuels", "noirs blancs asiatiques africains arabes européens immigrés étrangers", "aveugles sourds handicapés âgés jeunes"),
}
IDENTITY = tuple(Group(tuple(kind.split()), _SENTENCES[lang]) for lang, kinds in _TERMS.items() for kind in kinds)


@dataclass(frozen=True)
class ToxicityFit:
    """sample: the most labelled rows that are fitted on; min_rows: texts a word must occur in to be a feature; features: those kept whose share differs most between the labels; change: weight of the counterfactual penalty; swaps: other terms that a named one is swapped for; mention_every: of texts that name no group, one in so many is given a mention."""

    sample: int = 6_000
    min_rows: int = 4
    features: int = 3_000
    l1: float = 2e-4
    change: float = 4.0
    swaps: int = 2
    mention_every: int = 2
    rounds: int = 400
    rate: float = 0.5
    identity: tuple[Group, ...] = IDENTITY


@dataclass(frozen=True)
class ToxicityModel:
    """Feature keys in ascending order with their weights."""

    words: np.ndarray
    weights: np.ndarray
    bias: float


def _features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of the words of one step of texts, then of their beginnings of each length in PREFIXES.

    Words are lower-cased and lose ASCII punctuation at both ends.  A beginning
    counts where the word goes on after it: stems carry over to unseen endings.
    """
    words = X.Words(*X.flat(column), lower=True)
    start, end, row = words.start.copy(), words.end.copy(), words.row
    at = np.arange(len(start))
    while len(at := at[(end[at] > start[at]) & _EDGE[words.data[end[at] - 1]]]):
        end[at] -= 1
    at = np.flatnonzero(end > start)
    while len(at := at[(end[at] > start[at]) & _EDGE[words.data[np.minimum(start[at], len(words.data) - 1)]]]):
        start[at] += 1
    full = end > start
    start, end, row = start[full], end[full], row[full]
    yield row, X.hash_spans(words.data, start, end)
    for n in PREFIXES:
        longer = end - start > n
        start, end, row = start[longer], end[longer], row[longer]
        yield row, X.mix(X.hash_spans(words.data, start, start + n) + np.uint64(n))


def _distinct(row: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((keys, row))
    row, keys = row[order], keys[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])
    return row[new], keys[new]


def presences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for the distinct features of each text of one step, by row."""
    found = list(_features(column))
    return _distinct(np.concatenate([r for r, _ in found]), np.concatenate([k for _, k in found]))


def known(column: pa.Array, model: ToxicityModel) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in the model) for the model's features in each text; most others fall to a table of 16 bits of the key."""
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[model.words >> np.uint64(48)] = True
    rows, places = [], []
    for row, keys in _features(column):
        hit = np.flatnonzero(maybe[keys >> np.uint64(48)])
        place = np.minimum(np.searchsorted(model.words, keys[hit]), len(model.words) - 1)
        good = model.words[place] == keys[hit]
        rows.append(row[hit][good])
        places.append(place[good])
    return _distinct(np.concatenate(rows), np.concatenate(places))


def _keys_of(term: str) -> np.ndarray:
    """The features that a text has from a term: the word and its beginnings."""
    return np.concatenate([k for _, k in _features(pa.array([term], type=pa.large_string()))])


class Counterfactuals:
    """The versions of a text that are read: (rows of the loss, the one that is compared, the others), texts made one by one."""

    def __init__(self, o: ToxicityFit):
        self.o = o
        self.group = {t: g for g in o.identity for t in g.terms}
        self.any = re.compile("|".join(re.escape(t) for t in sorted(self.group, key=len, reverse=True)), re.I) if self.group else None

    def named(self, text: str) -> dict[str, list[tuple[int, int]]]:
        """The places of each term that stands as a word."""
        found: dict[str, list[tuple[int, int]]] = {}
        if self.any is not None and self.any.search(text):
            for m in _WORD.finditer(text):
                core = m[0].strip(_MARKS)
                term = core.translate(_ASCII_LOWER)
                if term in self.group:
                    at = m.start() + m[0].index(core)
                    found.setdefault(term, []).append((at, at + len(core)))
        return found

    def others(self, term: str, turn: int) -> list[str]:
        terms = [t for t in self.group[term].terms if t != term]
        return [terms[(turn + i) % len(terms)] for i in range(min(self.o.swaps, len(terms)))] if terms else []

    def versions(self, text: str) -> tuple[int, int, Iterator[str]]:
        """(rows of the loss, which of them the versions after them are compared with, all versions)."""
        turn = xxhash.xxh3_64_intdigest(text)
        found = self.named(text)
        if found:
            return 1, 0, itertools.chain([text], (self.put(text, found[t], b) for t in sorted(found) for b in [*self.others(t, turn), ""]))
        if not self.group or turn % self.o.mention_every:
            return 1, 0, iter([text])
        group = self.o.identity[turn // 64 % len(self.o.identity)]
        term = group.terms[turn // 8192 % len(group.terms)]
        ends = [m.end() for m in _SENTENCE.finditer(text)] or [len(text)]
        at = ends[turn // 2**20 % len(ends)]
        own = [term, *self.others(term, turn // 2**40)]
        return 2, 1, itertools.chain([text], (f"{text[:at]} {group.mention.format(t)} {text[at:]}" for t in own))

    @staticmethod
    def put(text: str, places: list[tuple[int, int]], term: str) -> str:
        parts, last = [], 0
        for lo, hi in places:
            parts += (text[last:lo], term)
            last = hi
        return "".join([*parts, text[last:]])


def _by_step(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[list[int], pa.Array]]:
    """(owners, texts) in steps of STEP_BYTES characters or of one longer text."""
    owners, some, held = [], [], 0
    for owner, text in texts:
        if some and held + len(text) > X.STEP_BYTES:
            yield owners, pa.array(some, type=pa.large_string())
            owners, some, held = [], [], 0
        owners.append(owner)
        some.append(text)
        held += len(text)
    if some:
        yield owners, pa.array(some, type=pa.large_string())


def _screened(some: DataFrame, o: ToxicityFit, share: float) -> np.ndarray:
    """The features whose share of toxic texts lies farthest from the whole's, in standard deviations, and those of identity terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Counterfactuals(o)
        for batch in batches:
            label = batch.column(1).to_numpy() > 0

            def read(column=X.texts(batch.column(0))) -> Iterator[tuple[int, str]]:
                for i, text in enumerate(column):
                    rows, _, texts = made.versions(text.as_py())
                    yield from ((i, x) for x in itertools.islice(texts, rows))

            for owners, column in _by_step(read()):
                row, keys = presences(column)
                names, place = np.unique(keys, return_inverse=True)
                n, t = np.bincount(place, minlength=len(names)), np.bincount(place, weights=label[np.array(owners)[row]], minlength=len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n), pa.array(t.astype(np.int64))], names=["key", "n", "t"])

    counts = some.mapInArrow(X.tidied(count), "key long, n long, t long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    apart = F.abs(F.col("t") - share * F.col("n")) / F.sqrt(share * (1 - share) * F.col("n"))
    identity = np.unique(np.concatenate([_keys_of(t) for g in o.identity for t in g.terms])).view(np.int64).tolist() if o.identity else []
    best = counts.where(F.col("n") >= o.min_rows).orderBy(apart.desc(), "key").limit(o.features).select("key").collect()
    return np.unique(np.array([*(r["key"] for r in best), *identity], dtype=np.int64).view(np.uint64))


@dataclass(frozen=True)
class Rows:
    """What is fitted: (row, place) of the features present in n rows with labels y, and of the differences of pairs (sign: 1 or -1)."""

    y: np.ndarray
    row: np.ndarray
    place: np.ndarray
    pairs: int
    pair: np.ndarray
    spot: np.ndarray
    sign: np.ndarray


def gathered(found: list[tuple[int, int, int, list[np.ndarray]]]) -> Rows:
    """From (label, rows of the loss, the compared one, places of each version's features) of each text."""
    y, rows, pairs = [], [], []
    for label, own, base, versions in found:
        y += [float(label)] * own
        rows += versions[:own]
        for other in [*versions[:base], *versions[own:]]:
            pairs.append((np.setdiff1d(versions[base], other), np.setdiff1d(other, versions[base])))
    none = np.zeros(0, np.int64)
    sizes = [(len(a), len(b)) for a, b in pairs]
    return Rows(
        np.array(y), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([none, *rows]),
        len(pairs), np.repeat(np.arange(len(pairs)), [a + b for a, b in sizes]), np.concatenate([none, *(x for p in pairs for x in p)]), np.repeat(np.tile([1.0, -1.0], len(pairs)), [n for s in sizes for n in s]),
    )


def objective(w: np.ndarray, bias: float, r: Rows, change: float) -> tuple[float, np.ndarray, float]:
    """The smooth part of what is minimised and its gradients: balanced log loss, and ``change`` times the mean squared change of the score over pairs."""
    weight = np.where(r.y > 0, 0.5 / r.y.mean(), 0.5 / (1 - r.y.mean())) / len(r.y)
    z = bias + np.bincount(r.row, weights=w[r.place], minlength=len(r.y))
    loss = float((weight * (np.logaddexp(0, z) - r.y * z)).sum())
    off = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - r.y)
    grad = np.bincount(r.place, weights=off[r.row], minlength=len(w))
    if r.pairs and change:
        apart = np.bincount(r.pair, weights=r.sign * w[r.spot], minlength=r.pairs)
        loss += change * float((apart**2).mean())
        grad += np.bincount(r.spot, weights=2 * change / r.pairs * apart[r.pair] * r.sign, minlength=len(w))
    return loss, grad, float(off.sum())


def fit(labelled: DataFrame, options: ToxicityFit | None = None, text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Fits on the rows of ``labelled``, at most ``options.sample``; only the chosen features of each reach the driver.

    A null label is left out, a null text counts as empty, repeated rows each
    count.  With labels of one kind only, every text is scored by them alone;
    without labels none is toxic.
    """
    o = options or ToxicityFit()
    chosen = labelled.where(F.col(label).isNotNull()).select(F.col(text).alias("text"), (F.col(label) > 0).cast("int").alias("label")).limit(o.sample)
    some = kept(chosen.repartition(16), "labelled")
    total = some.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    if not total["n"] or total["t"] in (0, total["n"]):
        drop_kept(some)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 4.0 if total["t"] else -4.0)
    words = _screened(some, o, total["t"] / total["n"])
    screen = ToxicityModel(words, np.ones(len(words)), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Counterfactuals(o)
        for batch in batches:
            loss, base, found = [], [], []

            def read(column=X.texts(batch.column(0))) -> Iterator[tuple[int, str]]:
                for i, text in enumerate(column):
                    rows, at, texts = made.versions(text.as_py())
                    loss.append(rows)
                    base.append(at)
                    found.append([])
                    yield from ((i, x) for x in texts)

            for owners, column in _by_step(read()):
                row, place = known(column, screen) if len(words) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                for owner, part in zip(owners, np.split(place.astype(np.int32), np.searchsorted(row, np.arange(1, len(owners)))), strict=True):
                    found[owner].append(part.tobytes())
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, type=k) for c, k in zip((loss, base, found), kinds, strict=True))], names=["label", "loss", "base", "found"])

    texts = sorted((r["label"], r["loss"], r["base"], [bytes(v) for v in r["found"]]) for r in some.mapInArrow(X.tidied(run), "label int, loss int, base int, found array<binary>").collect())
    drop_kept(some)
    rows = gathered([(y, n, b, [np.frombuffer(v, dtype=np.int32).astype(np.int64) for v in found]) for y, n, b, found in texts])

    w, bias = np.zeros(len(words)), float(np.log(rows.y.mean() / (1 - rows.y.mean())))
    seen, seen_bias = np.full(len(words), 1e-8), 1e-8
    for _ in range(o.rounds):
        _, grad, off = objective(w, bias, rows, o.change)
        seen += grad**2
        step = o.rate / np.sqrt(seen)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * o.l1, 0)
        seen_bias += off**2
        bias -= o.rate * off / np.sqrt(seen_bias)
    used = w != 0
    return ToxicityModel(words[used], w[used], bias)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5) added, replacing columns of those names.

    A null or empty text has the score of no words.  Whole texts are read; one
    pass, no shuffle; repeated rows each give a row.
    """
    carried = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType([*carried, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = X.texts(batch.column(batch.schema.get_field_index(text)))
            for lo, hi in X.steps(column):
                total = np.zeros(hi - lo)
                if len(model.words):
                    row, place = known(column.slice(lo, hi - lo), model)
                    total = np.bincount(row, weights=model.weights[place], minlength=hi - lo)
                p = 1 / (1 + np.exp(-np.clip(total + model.bias, -40, 40)))
                own = [batch.column(batch.schema.get_field_index(f.name)).slice(lo, hi - lo) for f in carried]
                yield pa.RecordBatch.from_arrays([*own, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[f.name for f in schema.fields])

    return docs.mapInArrow(X.tidied(run), schema)


def labelled_rows(docs: DataFrame, labels: DataFrame, options: ToxicityFit | None = None, folds: int = 5) -> DataFrame:
    """(text, toxic) of at most ``options.sample`` labelled documents whose crc32(doc_id) mod ``folds`` is not 0.

    Which ones is decided by a hash of the id.  The sample's ids are few enough
    to broadcast whatever the tables' size.  Labels of one id count once, 1 if any is.
    """
    o = options or ToxicityFit()
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) != 0))
    some = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(o.sample)
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic")


def held_out(folds: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == rest, F.lit(False))
