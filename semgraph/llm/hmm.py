"""Hidden Markov language model over whole corpora.

1. One pass numbers the words of each *block* of texts and keeps the texts as
   numbers beside the block's words, their training counts and their classes
   (a table in the shared folder).
2. The hidden states emit *symbols*: words that are frequent (by the sum of
   their counts over the blocks where they are among the ``candidates`` most
   frequent), and for all other words one of a fixed number of classes made from
   their first and last two characters.  Baum-Welch goes over symbols: every
   task sums expected counts over its whole training texts, Spark adds them up
   by cell, the driver divides.
3. With the last model every task sums the expected counts of its own words by
   state, and Spark adds them up by word: a table of all training words with
   their exact counts.  On the way a block's count of a word is exact, and its
   states' shares are bytes (steps of 1/255).
4. That table is joined back to the blocks' words, so only distinct words of
   blocks are shuffled and each token meets its exact corpus count.  In each
   state a word follows from its class by what that state has learned of it,
   drawn towards the class's unigram shares where it was seen seldom; an unknown
   word follows with what the discount leaves.
5. A scaled forward recursion over each whole text gives its exact likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .tables import drop_kept, kept


@dataclass(frozen=True)
class Hmm:
    """states (at most eight); top: words with a symbol of their own; classes: of the others; rounds of Baum-Welch; chunk: tokens whose chances are held at once; block: tokens numbered together; prior: tokens that a word's unigram share weighs against its own counts by state; tasks: the most that blocks are dealt to, each of which takes its blocks one after another."""

    states: int = 8
    top: int = 4096
    classes: int = 2048
    rounds: int = 5
    chunk: int = 800_000
    seeds: int = 192
    block: int = 3_000_000
    seed: int = 3
    prior: float = 4.0
    tasks: int = 8192

    @property
    def end(self) -> int:
        return self.top + self.classes

    @property
    def symbols(self) -> int:
        return self.top + self.classes + 1


BLOCKS = "block long, doc_ids array<long>, sizes array<int>, trains array<boolean>, seq binary, words array<binary>, counts array<int>"


def _blocks(docs: DataFrame, o: Hmm) -> DataFrame:
    """docs (doc_id, text, train) as blocks; seq: the words' numbers, one text after another."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]

    class Numbers(dict):
        def __missing__(self, word):
            n = self[word] = len(self)
            return n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        words, seqs, ids, trains, held = Numbers(), [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal made
            sizes = [len(s) for s in seqs]
            learned = [s for s, t in zip(seqs, trains, strict=True) if t]
            counts = np.bincount(np.concatenate(learned), minlength=len(words)) if learned else np.zeros(len(words), np.int64)
            row = [(task << 32) + made, ids, sizes, trains, np.concatenate(seqs).tobytes(), list(words), counts.astype(np.int32)]
            made += 1
            return pa.RecordBatch.from_arrays([pa.array([v], type=k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            column = X.texts(batch.column(1))
            for doc, train, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), column, strict=True):
                seq = np.fromiter(map(words.__getitem__, text.as_buffer().to_pybytes().lower().split()), np.int32)
                seqs.append(seq)
                ids.append(doc)
                trains.append(bool(train))
                held += len(seq) + 1
                if held >= o.block:
                    yield flush()
                    words, seqs, ids, trains, held = Numbers(), [], [], [], 0
        if seqs:
            yield flush()

    return docs.mapInArrow(X.tidied(run), BLOCKS)


def _symbol(word: Column, o: Hmm) -> Column:
    """The class symbol of a word that is not among the top ones."""
    text = word.cast("string")
    return (F.pmod(F.xxhash64(F.substring(text, 1, 2), F.substring(text, -2, 2)), F.lit(o.classes)) + o.top).cast("int")


def _seed_model(symbols: DataFrame, counts: np.ndarray, o: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A starting point from all training texts: symbols that meet in the same texts start in the same state."""
    common = np.sort(np.argsort(-counts[: o.end], kind="stable")[: o.seeds])
    place = np.full(o.symbols, -1)
    place[common] = np.arange(len(common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(common), len(common)))
        for batch in batches:
            x = np.zeros((batch.num_rows, len(common)))
            for r, s in enumerate(batch.column(0)):
                at = place[np.frombuffer(s.as_buffer(), dtype=np.uint16)]
                x[r, at[at >= 0]] = 1
            total += x.T @ x
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    met = np.zeros((len(common), len(common)))
    for i, j, v in symbols.mapInArrow(X.tidied(run), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        met[i, j] = v
    alone = np.maximum(np.diag(met), 1)
    near = np.log((met + 0.5) * alone.max() / np.outer(alone, alone) + 1e-9)
    near -= near.mean(axis=0)
    value, vector = np.linalg.eigh((near + near.T) / 2)
    spots = vector[:, np.argsort(-np.abs(value))[: o.states]] * np.sqrt(np.sort(np.abs(value))[::-1][: o.states])
    centres = [spots[np.argmax(counts[common])]]
    while len(centres) < o.states:  # farthest first, then a few rounds of k-means
        centres.append(spots[np.argmax(np.min([((spots - c) ** 2).sum(axis=1) for c in centres], axis=0))])
    centres = np.array(centres)
    for _ in range(20):
        own = ((spots[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([spots[own == k].mean(axis=0) if (own == k).any() else centres[k] for k in range(o.states)])
    shift = np.random.default_rng(o.seed).uniform(0.9, 1.1, (o.symbols, o.states))
    emit = (counts[:, None] + 0.5) * shift
    emit[common] *= np.where(own[:, None] == np.arange(o.states), 8.0, 0.25)
    move = np.full((o.states, o.states), 0.2 / o.states) + 0.8 * np.eye(o.states)
    return emit / emit.sum(axis=0), move, np.full(o.states, 1 / o.states)


def _by_step(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens, those of step 0 first, and where each step begins (one more: the end); longer sequences come first in each step."""
    size = np.array([len(s) for s in sequences])
    order = np.argsort(-size, kind="stable")
    flat, size = np.concatenate([sequences[i] for i in order]), size[order]
    begins = np.r_[0, np.cumsum(np.searchsorted(-size, -np.arange(size[0]), side="left"))]
    step = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out = np.empty_like(flat)
    out[begins[step] + np.repeat(np.arange(len(size)), size)] = flat
    return out, begins


def _cuts(begins: np.ndarray, chunk: int) -> list[int]:
    """Steps at which stretches of about ``chunk`` tokens begin, and the end."""
    cuts = [0]
    for t in range(1, len(begins) - 1):
        if begins[t + 1] - begins[cuts[-1]] > chunk:
            cuts.append(t)
    return [*cuts, len(begins) - 1]


def _forward(given: np.ndarray, bounds: list[int], move: np.ndarray, first: np.ndarray, entry: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Scaled chances of the states after each token of a stretch, and 1 / scale; entry: the chances at the step before, None at the beginning."""
    ahead, inverse, one = np.empty_like(given), np.empty((len(given), 1), dtype=given.dtype), np.ones((len(move), 1), dtype=given.dtype)
    now = entry
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own, size = ahead[a:b], inverse[a:b]
        if now is None:
            np.multiply(given[a:b], first, out=own)
        else:
            np.matmul(now[: b - a], move, out=own)
            own *= given[a:b]
        np.matmul(own, one, out=size)
        np.reciprocal(size, out=size)
        own *= size
        now = own
    return ahead, inverse


def _posteriors(symbols: np.ndarray, begins: np.ndarray, emit: np.ndarray, move: np.ndarray, first: np.ndarray, chunk: int, moved: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, chances of the states) of stretches of ``symbols`` (as by _by_step), given whole sequences; expected moves are added to ``moved``.

    Steps go in stretches of about ``chunk`` tokens.  Where there are several,
    one forward pass keeps the chances at their borders, and the pass back,
    last stretch first, makes the others anew, so a sequence of any length
    takes the same memory.  In the precision of ``emit``.
    """
    cuts, kind = _cuts(begins, chunk), emit.dtype
    move, first = move.astype(kind), first.astype(kind)
    back = np.ascontiguousarray(move.T)

    def stretch(lo: int, hi: int, entry: np.ndarray | None) -> tuple:
        bounds = (begins[lo : hi + 1] - begins[lo]).tolist()
        given = emit.take(symbols[begins[lo] : begins[hi]], axis=0)
        return given, bounds, *_forward(given, bounds, move, first, entry)

    entries: list[np.ndarray | None] = [None]
    for lo, hi in zip(cuts[:-2], cuts[1:-1], strict=True):
        _, bounds, ahead, _ = stretch(lo, hi, entries[-1])
        entries.append(ahead[bounds[-2] :].copy())
    later = np.zeros((0, len(move)), dtype=kind)  # what follows the next step says, for those of its sequences that go on
    total = np.zeros_like(move, dtype=np.float64)
    for lo, hi, entry in zip(cuts[-2::-1], cuts[:0:-1], entries[::-1], strict=True):
        given, bounds, ahead, inverse = stretch(lo, hi, entry)
        given *= inverse
        for t in range(hi - lo - 1, -1, -1):
            a, b, k = bounds[t], bounds[t + 1], len(later)
            own = given[a:b]
            own[:k] *= later
            if moved is not None and (t or entry is not None):
                total += (ahead[bounds[t - 1] : bounds[t - 1] + b - a] if t else entry[: b - a]).T @ own
            ahead[a : a + k] *= later
            later = own @ back
        yield begins[lo], begins[hi], ahead
    if moved is not None:
        moved += move * total


def _groups(sequences: list[np.ndarray], chunk: int) -> Iterator[list[np.ndarray]]:
    """The sequences by length, in groups of at most ``chunk`` tokens or of one."""
    part, held = [], 0
    for s in sorted(sequences, key=len):
        if part and held + len(s) > chunk:
            yield part
            part, held = [], 0
        part.append(s)
        held += len(s)
    if part:
        yield part


def _expect(symbols: DataFrame, model: tuple, o: Hmm) -> np.ndarray:
    """Expected counts over all training texts: a row for each symbol, then moves from each state, then first states."""
    emit, move, first = model[0].astype(np.float32), *model[1:]
    width = o.symbols + o.states + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, o.states))
        for batch in batches:
            for part in _groups([np.frombuffer(s.as_buffer(), dtype=np.uint16) for s in batch.column(0)], o.chunk):
                tokens, begins = _by_step(part)
                for lo, hi, chances in _posteriors(tokens, begins, emit, move, first, o.chunk, total[o.symbols : o.symbols + o.states]):
                    order = np.argsort(tokens[lo:hi], kind="stable")
                    ordered = tokens[lo:hi][order]
                    cut = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
                    total[ordered[cut]] += np.add.reduceat(chances.take(order, axis=0), cut, axis=0, dtype=np.float64)
                    if lo == 0:
                        total[-1] += chances[: begins[1]].sum(axis=0)
        i, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[i, k])], names=["i", "k", "v"])

    sums = np.zeros((width, o.states))
    for i, k, v in symbols.mapInArrow(X.tidied(run), "i int, k int, v double").groupBy("i", "k").agg(F.sum("v").alias("v")).collect():
        sums[i, k] = v
    return sums


def _maximise(sums: np.ndarray, counts: np.ndarray, o: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The next model; each state's emissions are drawn a little towards the corpus's."""
    share = (counts + 0.5) / (counts + 0.5).sum()
    emit = sums[: o.symbols] + 50 * share[:, None]
    move = sums[o.symbols : o.symbols + o.states] + 1.0
    first = sums[-1] + 0.1
    return emit / emit.sum(axis=0), move / move.sum(axis=1)[:, None], first / first.sum()


def _tops(blocks: DataFrame, o: Hmm) -> list[bytes]:
    """The ``o.top`` most frequent training words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words, counts = batch.column(0)[row].values, batch.column(1)[row].values.to_numpy()
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([words.take(pa.array(at)), pa.array(counts[at].astype(np.int64))], names=["word", "n"])

    sums = blocks.select("words", "counts").mapInArrow(X.tidied(run), "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    best = kept(sums.orderBy(F.desc("c"), "word").limit(o.top), "tops")  # its shuffle files go with that
    found = [bytes(r["word"]) for r in best.orderBy(F.desc("c"), "word").collect()]
    drop_kept(best)
    return found


def _rows(batch: pa.RecordBatch, place: dict[bytes, int]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(words, their counts, their symbols, training texts as numbers) of each block; ``place``: words with symbols of their own."""
    for row in range(batch.num_rows):
        words, counts, symbol = (batch.column(c)[row].values for c in ("words", "counts", "symbols"))
        own = np.fromiter((place.get(w, -1) for w in words.to_pylist()), np.int64, len(words))
        seq = np.frombuffer(batch.column("seq")[row].as_buffer(), dtype=np.int32)
        texts = np.split(seq, np.cumsum(batch.column("sizes")[row].values.to_numpy())[:-1])
        yield words, counts.to_numpy(), np.where(own >= 0, own, symbol.to_numpy()), [t for t, train in zip(texts, batch.column("trains")[row].as_py(), strict=True) if train]


def _training_symbols(blocks: DataFrame, place: dict[bytes, int], o: Hmm) -> DataFrame:
    """(symbols): each training text and its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ending = np.array([o.end], dtype=np.uint16).tobytes()
        for batch in batches:
            for _, _, symbol, texts in _rows(batch, place):
                marks = symbol.astype(np.uint16)
                for lo in range(0, len(texts), 1024):
                    yield pa.RecordBatch.from_arrays([pa.array([marks[t].tobytes() + ending for t in texts[lo : lo + 1024]], type=pa.binary())], names=["symbols"])

    return blocks.select("seq", "sizes", "trains", "words", "counts", "symbols").mapInArrow(X.tidied(run), "symbols binary")


def _symbol_counts(symbols: DataFrame, o: Hmm) -> np.ndarray:
    """How often each symbol stands in all training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(o.symbols, dtype=np.int64)
        for batch in batches:
            for s in batch.column(0):
                total += np.bincount(np.frombuffer(s.as_buffer(), dtype=np.uint16), minlength=o.symbols)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["i", "n"])

    out = np.zeros(o.symbols)
    for i, n in symbols.mapInArrow(X.tidied(run), "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[i] = n
    return out


def _by_state(c: np.ndarray, packed: list[bytes | None], o: Hmm) -> np.ndarray:
    """Expected counts by state of words with count c and packed shares; none for a word that isn't known."""
    shares = np.frombuffer(b"".join(p or bytes(2 * o.states) for p in packed), dtype=np.float16).reshape(len(packed), o.states).astype(np.float32)
    return (c[:, None] * shares / np.maximum(shares.sum(axis=1), 1e-9)[:, None]).astype(np.float32)


def _packed(learned: DataFrame, o: Hmm) -> DataFrame:
    """(word, c, q): the states' shares of the expected counts, in half precision (three digits, down to 6e-8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = np.column_stack([batch.column(f"g{k}").to_numpy() for k in range(o.states)])
            shares = (g / np.maximum(g.sum(axis=1), 1e-30)[:, None]).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array([row.tobytes() for row in shares], type=pa.binary())], names=["word", "c", "q"])

    return learned.mapInArrow(X.tidied(run), "word binary, c long, q binary")


def _word_states(blocks: DataFrame, place: dict[bytes, int], model: tuple, o: Hmm) -> DataFrame:
    """(word, c, g0, ...): of each training word, its count and its expected counts by state; these are 0 for words with symbols of their own, whose counts the model holds."""
    emit, move, first = model[0].astype(np.float32), *model[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts, symbol, texts in _rows(batch, place):
                n = len(words)  # its number stands for the end
                symbols, total = np.r_[symbol, o.end].astype(np.uint16), np.zeros((n, o.states), dtype=np.float32)
                for part in _groups([np.r_[text, np.int32(n)] for text in texts], o.chunk):
                    tokens, begins = _by_step(part)
                    marks = symbols[tokens]
                    for lo, hi, chances in _posteriors(marks, begins, emit, move, first, o.chunk):
                        at = np.flatnonzero((marks[lo:hi] >= o.top) & (marks[lo:hi] < o.end))
                        own, chances = tokens[lo:hi][at], chances.take(at, axis=0)
                        for k in range(o.states):
                            total[:, k] += np.bincount(own, weights=chances[:, k], minlength=n)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([words.take(pa.array(at)), pa.array(counts[at].astype(np.int32)), *(pa.array(total[at, k]) for k in range(o.states))], names=["word", "n", *states])

    states = [f"g{k}" for k in range(o.states)]
    parts = blocks.select("seq", "sizes", "trains", "words", "counts", "symbols").mapInArrow(X.tidied(run), ", ".join(["word binary, n int", *(f"{g} float" for g in states)]))
    return parts.groupBy("word").agg(F.sum("n").alias("c"), *(F.sum(g).cast("float").alias(g) for g in states))


def log_likelihoods(sequences: list[np.ndarray], model: tuple, chunk: int = 400_000) -> np.ndarray:
    """log10 of the probability of each whole sequence, by a scaled forward recursion; a sequence holds one symbol at least."""
    emit, move, first = model
    out, place = np.empty(len(sequences)), sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
    done = 0
    for part in _groups(sequences, chunk):
        tokens, begins = _by_step(part)
        rows = np.array(place[done : done + len(part)])[np.argsort([-len(s) for s in part], kind="stable")]
        done += len(part)
        total, entry, cuts = np.zeros(len(part)), None, _cuts(begins, chunk)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            bounds = (begins[lo : hi + 1] - begins[lo]).tolist()
            ahead, inverse = _forward(emit.take(tokens[begins[lo] : begins[hi]], axis=0), bounds, move, first, entry)
            logs = np.log10(inverse[:, 0])
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                total[: b - a] -= logs[a:b]
            entry = ahead[bounds[-2] :].copy()
        out[rows] = total
    return out


def word_shares(c: np.ndarray, symbol: np.ndarray, by_state: np.ndarray, tokens: np.ndarray, kinds: np.ndarray, cut: float, of_class: np.ndarray, whole_class: np.ndarray, o: Hmm) -> np.ndarray:
    """Of words by count, symbol and expected counts by state: the chance in each state that the symbol is this word; the known words of a class and the unknown one add up to 1."""
    mass = np.maximum(tokens[symbol], 1)
    unknown = np.where(tokens[symbol] > 0, cut * kinds[symbol] / mass, 1.0)
    usual = (c - cut) / np.maximum(tokens[symbol] - cut * kinds[symbol], 1e-9)
    weight = (c / (c + o.prior))[:, None]
    known = (weight * by_state + (1 - weight) * usual[:, None] * of_class[symbol]) / whole_class[symbol]
    shares = np.where(c[:, None] > 0, (1 - unknown[:, None]) * known, unknown[:, None])
    shares[symbol < o.top] = 1.0
    return shares


def score(docs: DataFrame, held_out: Column, options: Hmm | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    The model learns from all rows where ``held_out`` is false or null.  Tokens
    are words, A-Z lower-cased, and one end.  base_score: add-half unigram
    log10 probability.  A null or empty text is its end alone; repeated rows
    each count and each give a row.  Without training rows every word is unknown;
    an empty table gives no rows.
    """
    o = options or Hmm()
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), (~F.coalesce(held_out, F.lit(False))).alias("train"))
    blocks = kept(_blocks(given, o).withColumn("symbols", F.transform("words", lambda w: _symbol(w, o))), "blocks")
    place = {w: i for i, w in enumerate(_tops(blocks, o))}
    learn = kept(_training_symbols(blocks, place, o), "symbols")
    tokens = _symbol_counts(learn, o)
    model = _seed_model(learn, tokens, o)
    for _ in range(o.rounds if tokens[o.end] else 0):
        model = _maximise(_expect(learn, model, o), tokens, o)
    drop_kept(learn)

    learned = kept(_word_states(blocks, place, model, o), "words")
    own = docs.sparkSession.createDataFrame([(bytearray(w), i) for w, i in place.items()], "word binary, own int")

    def with_symbol(df: DataFrame, symbol: Column) -> DataFrame:
        # At most o.top rows are broadcast.
        return df.join(F.broadcast(own), "word", "left").withColumn("symbol", F.coalesce("own", symbol)).drop("own")

    weight = F.col("c") / (F.col("c") + o.prior)
    of_state = [F.col(f"g{k}") for k in range(o.states)]
    plain = [F.count("*").alias("n"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"), F.sum((1 - weight) * F.col("c")).alias("rest"), F.sum(1 - weight).alias("lost")]
    found = with_symbol(learned, _symbol(F.col("word"), o)).groupBy("symbol").agg(*plain, *(F.sum(g).alias(f"g{k}") for k, g in enumerate(of_state)), *(F.sum(weight * g).alias(f"w{k}") for k, g in enumerate(of_state))).collect()
    once, twice = sum(r["n1"] for r in found), sum(r["n2"] for r in found)
    cut = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
    kinds = np.zeros(o.symbols)
    for r in found:
        kinds[r["symbol"]] = r["n"]
    trains = int(tokens[o.end])
    whole, distinct = int(tokens.sum()), int(kinds.sum()) + (trains > 0)
    unit = np.log10(whole + 0.5 * (distinct + 1))
    # Of each class: expected counts by state, and what its words' shares add up to before they are divided by it.
    of_class, whole_class = np.zeros((o.symbols, o.states)), np.ones((o.symbols, o.states))
    spare = np.maximum(tokens - cut * kinds, 1e-9)  # of a class's tokens, those left by the discount
    for r in found:
        if (s := r["symbol"]) >= o.top:
            of_class[s] = np.array([r[f"g{k}"] for k in range(o.states)]) + 1e-9
            whole_class[s] = [r[f"w{k}"] for k in range(o.states)] + (r["rest"] - cut * r["lost"]) / spare[s] * of_class[s]

    spots = blocks.select("block", "symbols", F.posexplode("words").alias("at", "word")).select("block", "at", "word", F.col("symbols")[F.col("at")].alias("class"))
    known = with_symbol(spots.join(_packed(learned, o), "word", "left"), F.col("class")).select("block", "at", F.coalesce("c", F.lit(0)).alias("c"), "symbol", "q")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = [c.split()[0] for c in schema.split(", ")]
    emit, move, first = model

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("at").to_numpy()
        c, symbol, states = np.zeros(len(at)), np.zeros(len(at), dtype=np.int64), np.zeros((len(at), o.states), dtype=np.float32)
        c[at], symbol[at] = right.column("c").to_numpy(), right.column("symbol").to_numpy()
        states[at] = _by_state(c[at], right.column("q").to_pylist(), o)
        chances = np.empty((len(at) + 1, o.states))
        chances[-1] = emit[o.end]
        for lo in range(0, len(at), 1 << 16):
            part = slice(lo, min(len(at), lo + (1 << 16)))
            chances[part] = emit[symbol[part]] * word_shares(c[part], symbol[part], states[part].astype(np.float64), tokens, kinds, cut, of_class, whole_class, o)
        base, seen = np.log10(c + 0.5) - unit, c > 0
        out: list[list] = [[] for _ in names]
        for row in range(left.num_rows):
            seq = np.frombuffer(left.column("seq")[row].as_buffer(), dtype=np.int32)
            bounds = np.r_[0, np.cumsum(left.column("sizes")[row].values.to_numpy())].astype(np.int64)
            ids, train = left.column("doc_ids")[row].as_py(), left.column("trains")[row].as_py()
            total = lambda v: np.array([v[seq[a:b]].sum() for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
            out[0] += ids
            out[1] += [not t for t in train]
            out[2] += (np.diff(bounds) + 1).tolist()
            out[3] += (total(seen) + (trains > 0)).astype(np.int64).tolist()
            out[4] += [whole] * len(ids)
            out[5] += (total(base) + np.log10(trains + 0.5) - unit).tolist()
            out[6] += log_likelihoods([np.append(seq[a:b], len(at)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], (chances, move, first)).tolist()
        kinds_ = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(v, type=k) for v, k in zip(out, kinds_, strict=True)], names=names)

    parts = max(1, min(o.tasks, blocks.count()))
    left = blocks.select(F.col("block").alias("of"), "doc_ids", "sizes", "trains", "seq").repartition(parts, "of")
    return left.groupBy("of").cogroup(known.repartition(parts, "block").groupBy("block")).applyInArrow(meet, schema)
