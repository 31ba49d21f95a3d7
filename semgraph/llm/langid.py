"""Language identification by compression.

For each language a zstandard raw-content dictionary is made, on the executors,
of the sentences of a bounded sample of its training texts, drawn by hashes alone.
A text's letters are cut into chunks that are compressed with every dictionary; the language whose dictionary gives the fewest bytes in
all is chosen, and the choice is rejected where the next one is nearly as small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops as X
from .tables import drop_kept, kept

_SENTENCE = regex.compile(r"[.!?\n]+")
_REST = regex.compile(r"\P{L}+")


def letters(text: str) -> str:
    """The text in lower case with one space for everything between its letters."""
    return _REST.sub(" ", text.lower()).strip()


@dataclass(frozen=True)
class LangFit:
    """texts: of each language at most so many different texts are drawn, each whole; size: bytes of their sentences that a dictionary holds, about, and the most that the driver sees of a language."""

    texts: int = 200
    size: int = 1 << 20
    level: int = 5
    chunk: int = 4096
    margin: float = 0.01


def sample(docs: DataFrame, o: LangFit, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, h, text): of each language the ``o.texts`` different texts with the smallest hashes.

    Different texts are counted by language with partial aggregation; a row's
    hash then tells at once whether it may be among the smallest, so about
    twice the wanted rows are all that meets by language, and all that carries
    a text, however many rows a language has.
    """
    session = docs.sparkSession
    usable = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    usable = usable.select("*", F.explode(F.array(F.xxhash64("text"))).alias("h"))
    found = []
    for r in usable.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect():
        # Twice the rows that are wanted: fewer than wanted fall below in less than one of 10**9 cases.
        share = min(1.0, 2 * max(o.texts, 50) / r["n"])
        found.append((r["lang"], int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1))
    # One row a language.
    bounds = session.createDataFrame(found, "lang string, most long")
    near = usable.join(F.broadcast(bounds), "lang").where(F.col("h") <= F.col("most")).dropDuplicates(["lang", "h"])
    return near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= o.texts).select("lang", "h", "text")


def _sentences(texts: DataFrame, o: LangFit) -> DataFrame:
    """(lang, h, at, part): the sentences of texts, their letters as bytes; a longer one in pieces of ``o.chunk``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = [data[i : i + o.chunk] for x in _SENTENCE.split(text) if (data := letters(x).encode()) for i in range(0, len(data), o.chunk)]
                for lo in range(0, len(parts), 8192):
                    some = parts[lo : lo + 8192]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array([h] * len(some)), pa.array(range(lo, lo + len(some)), type=pa.int64()), pa.array(some, type=pa.binary())], names=["lang", "h", "at", "part"])

    return texts.mapInArrow(X.tidied(run), "lang string, h long, at long, part binary")


def _joined(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The parts of each group one after another, in the order of their texts; a group holds about ``size`` bytes."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("h", "at", "part"))), lambda x: x["part"].cast("string"))
    return parts.groupBy(*keys).agg(F.array_join(listed, "\n").cast("binary").alias("content"))


def fit(docs: DataFrame, options: LangFit | None = None, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A dictionary's content for each language of ``docs``; which texts and sentences is decided by hashes, so length plays no part.

    Null languages and null or empty texts are left out; repeated texts count
    once.  A sentence that occurs twice in the sample would mark its copies in
    another language's texts, and goes; one with a wrong label, or quoted from
    another language, would make its copies look like that, so one that the other half of
    the sample takes for another language goes too.  A language that would lose
    all its sentences in a step keeps them.  No rows give no dictionary.
    """
    o = options or LangFit()
    parts = _sentences(sample(docs, o, text, lang), o)
    once = parts.groupBy("lang", "part").agg(F.count("*").alias("n"), F.min(F.struct("h", "at")).alias("first"))
    often = parts.groupBy("part").agg((F.count("*") > 1).alias("often"))
    once = kept(once.join(often, "part").select("lang", "part", "first.*", "often"), "sentences")
    about = once.groupBy("lang").agg(F.count_if(~F.col("often")).alias("single"), F.sum(F.when(~F.col("often"), F.length("part"))).alias("some"), F.sum(F.length("part")).alias("all")).collect()
    # One row a language: whether sentences that occur twice go, and up to which hash the others are taken.
    rule = []
    for r in about:
        share = o.size / (r["some"] if r["single"] else r["all"])
        rule.append((r["lang"], bool(r["single"]), int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1))
    bounds = docs.sparkSession.createDataFrame(rule, "lang string, single boolean, most long")
    taken = once.join(F.broadcast(bounds), "lang").where((~F.col("often") | ~F.col("single")) & (F.xxhash64("part") <= F.col("most")))
    taken = kept(taken.select("lang", "h", "at", "part", F.pmod(F.xxhash64("part", F.lit(1)), F.lit(2)).cast("int").alias("half")), "sentences")
    drop_kept(once)
    halves: list[dict[str, bytes]] = [{}, {}]
    for r in _joined(taken, ["lang", "half"]).collect():
        halves[r["half"]][r["lang"]] = bytes(r["content"])
    good = kept(taken.mapInArrow(X.tidied(_agreeing(halves, o)), "lang string, h long, at long, part binary, good boolean"), "sentences")
    some = {r["lang"] for r in good.where("good").select("lang").distinct().collect()}
    content = _joined(good.where(F.col("good") | ~F.col("lang").isin(sorted(some))), ["lang"]).collect()
    drop_kept(taken, good)
    return {r["lang"]: bytes(r["content"]) for r in sorted(content)}


def presses(dictionaries: dict[str, bytes], level: int) -> dict[str, Callable[[bytes], bytes]]:
    """A compressor for each language."""
    out = {}
    for name, content in sorted(dictionaries.items()):
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=level)
        out[name] = zstandard.ZstdCompressor(dict_data=data, write_content_size=False).compress
    return out


def _agreeing(halves: list[dict[str, bytes]], o: LangFit) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tells of (lang, h, at, part, half) whether the other half of the sample takes the part for its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = [presses(half, o.level) for half in halves]
        for batch in batches:
            lang, _, _, part, half = (c.to_pylist() for c in batch.columns)
            good = [name in (other := press[1 - h]) and min((len(f(p)), n != name) for n, f in other.items())[1] is False for name, p, h in zip(lang, part, half, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(good, type=pa.bool_())], names=["lang", "h", "at", "part", "good"])

    return run


def identify(docs: DataFrame, dictionaries: dict[str, bytes], options: LangFit | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` added, replacing columns of those names.

    score: m / (m + 0.02) for the margin m = 1 - fewest / next fewest bytes; 1
    where only one language is known.  rejected: m is below ``options.margin``.
    A null text or one without letters is ``und`` with score 0, as is every
    text where no language was learned.  Where two dictionaries give the same
    bytes the name that sorts first is taken.  Whole texts are read, in one
    pass; repeated rows each give a row; an empty table gives an empty one.
    """
    o = options or LangFit()
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    carried = [f for f in docs.schema.fields if f.name not in {a.name for a in added}]
    schema = T.StructType([*carried, *added])
    names = sorted(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = list(presses(dictionaries, o.level).values())

        def one(value: str) -> tuple[str, float, bool]:
            data = letters(value).encode()
            if not names or not data:
                return "und", 0.0, True
            chunks = [data[i : i + o.chunk] for i in range(0, len(data), o.chunk)]
            sizes = sorted((sum(len(f(c)) for c in chunks), name) for f, name in zip(press, names, strict=True))
            if len(sizes) == 1:
                return sizes[0][1], 1.0, False
            m = 1 - sizes[0][0] / sizes[1][0]
            return sizes[0][1], m / (m + 0.02), m < o.margin

        for batch in batches:
            column = X.texts(batch.column(batch.schema.get_field_index(text)))
            for lo, hi in X.steps(column):
                found = [one(v.as_py()) for v in column.slice(lo, hi - lo)]
                own = [batch.column(batch.schema.get_field_index(f.name)).slice(lo, hi - lo) for f in carried]
                made = [pa.array(c, type=k) for c, k in zip(zip(*found, strict=True), (pa.string(), pa.float64(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([*own, *made], names=[f.name for f in schema.fields])

    return docs.mapInArrow(X.tidied(run), schema)
