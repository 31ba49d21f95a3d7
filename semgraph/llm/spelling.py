"""Spelling variants of the words of a corpus, by full neighbourhood generation.

Words are counted over all texts.  For each word of the vocabulary all distinct
deletions, replacements and insertions of one letter of the observed alphabet
are made; those that are words themselves are found by an equality join with
the vocabulary, so no distance is ever computed.  Each word points at its most
frequent near word if that is frequent enough, and pointers are followed to
their ends by doubling.

A candidate's hash follows in one step from prefix sums of its word's polynomial
hash.  Candidates whose bits are missing in a bit set of the vocabulary (of at
most ``filter_bits``) are no words and are never written out; the join decides on
the rest, so a full bit set costs rows, not results.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .tables import drop_kept, kept

LETTERS = "a-zÀ-ÿ"
_OTHER = re.compile(f"[^{LETTERS}]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))


@dataclass(frozen=True)
class Spelling:
    """min_length, min_count: of a word; ratio: how many times more frequent a word's form is; spoil: every so manieth (doc, run) loses a letter (0: none); step: candidates made at once; tally: words a task counts before it sends them; filter_bits: the most bits of the vocabulary's bit set (16 MB)."""

    min_length: int = 5
    min_count: int = 3
    ratio: int = 2
    spoil: int = 0
    step: int = 1 << 20
    tally: int = 100_000
    filter_bits: int = 1 << 27


def _pieces(text: str, size: int = 1 << 22) -> Iterator[str]:
    """The text in pieces that end between runs."""
    at = 0
    while len(text) - at > size:
        cut = _OTHER.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def word_counts(docs: DataFrame, o: Spelling) -> DataFrame:
    """(word, n): the words of all texts; docs: (doc_id, text)."""
    runs = re.compile(f"[{LETTERS}]{{{o.min_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(tally.keys(), type=pa.string()), pa.array(tally.values(), type=pa.int64())], names=["word", "n"])
            tally.clear()
            return batch

        for batch in batches:
            for key, raw in zip(batch.column(0), batch.column(1), strict=True):
                if not raw.is_valid:
                    continue
                seed = zlib.crc32((str(key.as_py()) if key.is_valid else "").encode() + b":")
                for piece in _pieces(raw.as_buffer().to_pybytes().translate(_LOWER).decode("utf-8", "replace")):
                    for word, n in Counter(runs.findall(piece)).items():
                        if o.spoil:
                            h = zlib.crc32(word.encode(), seed)
                            if h % o.spoil == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < o.min_length:
                                    continue
                        tally[word] += n
                    if len(tally) >= o.tally:
                        yield rows()
        if tally:
            yield rows()

    found = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(X.tidied(run), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= o.min_count)


def _powers(length: int) -> np.ndarray:
    out = np.full(length, np.uint64(_BASE))
    out[0] = 1
    return np.multiply.accumulate(out)


def _by_length(words: list[str], cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points) of words of one length, at most ``cells`` code points at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        at, rows = np.flatnonzero(lengths == length), max(1, cells // max(1, int(length)))
        for lo in range(0, len(at), rows):
            some = at[lo : lo + rows]
            points = np.frombuffer("".join(words[i] for i in some).encode("utf-16-le"), dtype=np.uint16)
            yield some, points.reshape(len(some), int(length)).astype(np.uint64)


def _hashes(points: np.ndarray) -> np.ndarray:
    return (points * _powers(points.shape[1])).sum(axis=1, dtype=np.uint64)


def _bits(h: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    m = X.mix(h)
    return m >> np.uint64(shift), X.mix(m) >> np.uint64(shift)


def _bit_set(words: DataFrame, log: int) -> np.ndarray:
    """The vocabulary's bits, 2**log of them, put together on the executors."""
    shift = 64 - log

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, points in _by_length(batch.column(0).to_pylist(), 1 << 20):
                bit = np.concatenate(_bits(_hashes(points), shift))
                yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64))], names=["place", "bits"])

    found = words.select("word").mapInArrow(X.tidied(run), "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (log - 6), dtype=np.uint64)
    out[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _alphabet(words: DataFrame) -> str:
    """The letters of the vocabulary; at most as many as LETTERS has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            seen.update("".join(batch.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), type=pa.string())], names=["letter"])

    return "".join(sorted(r["letter"] for r in words.select("word").mapInArrow(X.tidied(run), "letter string").distinct().collect()))


def candidates(words: DataFrame, alphabet: str, o: Spelling, bits: np.ndarray, log: int) -> DataFrame:
    """(word, n, candidate): each distinct string one letter away from a word, but those that the bit set rules out."""
    letters, shift = np.array([ord(c) for c in alphabet], dtype=np.uint64), 64 - log

    def known(h: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        at = np.flatnonzero(wanted)
        first, second = _bits(h.reshape(-1)[at], shift)
        held = np.flatnonzero(bits[first >> np.uint64(6)] >> (first & np.uint64(63)) & np.uint64(1))
        second = second[held]
        held = held[bits[second >> np.uint64(6)] >> (second & np.uint64(63)) & np.uint64(1) == 1]
        return np.unravel_index(at[held], h.shape)

    def neighbours(points: np.ndarray, words: list[str]) -> Iterator[tuple[int, str]]:
        n, length = points.shape
        power = _powers(length + 2)
        before = np.zeros((n, length + 1), dtype=np.uint64)
        np.cumsum(points * power[:length], axis=1, out=before[:, 1:])
        whole = before[:, -1:]
        # Of equal letters in a row, only the first is deleted.
        wanted = np.ones((n, length), dtype=bool)
        wanted[:, 1:] = points[:, 1:] != points[:, :-1]
        for r, i in zip(*known(before[:, :-1] + (whole - before[:, 1:]) * _INVERSE, wanted), strict=True):
            yield r, words[r][:i] + words[r][i + 1 :]
        for lo in range(0, length + 1, block := max(1, o.step // max(1, n * len(letters)))):
            own = points[:, lo : lo + block, None]
            h = whole[:, :, None] + (letters - own) * power[lo : lo + own.shape[1], None]
            for r, i, a in zip(*known(h, own != letters), strict=True):
                yield r, words[r][: lo + i] + alphabet[a] + words[r][lo + i + 1 :]
            # Not before the same letter: that is an insertion after it.
            some = before[:, lo : lo + block]
            h = some[:, :, None] + letters * power[lo : lo + some.shape[1], None] + ((whole - some) * power[1])[:, :, None]
            wanted = np.ones(h.shape, dtype=bool)
            wanted[:, : own.shape[1]] = own != letters
            for r, i, a in zip(*known(h, wanted), strict=True):
                yield r, words[r][: lo + i] + alphabet[a] + words[r][lo + i :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            for at, points in _by_length(words, max(1, o.step // max(1, len(letters)))):
                found = list(neighbours(points, [words[i] for i in at]))
                own = pa.array(at[[r for r, _ in found]] if found else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), counts.take(own), pa.array([c for _, c in found], type=pa.string())], names=["word", "n", "candidate"])

    return words.select("word", "n").mapInArrow(X.tidied(run), "word string, n long, candidate string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where each word's forms end.  A form is ``ratio`` times as frequent, so chains are short and have no rings."""
    roots = kept(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = kept(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        drop_kept(roots)
        roots = moved.select("word", "root")
        if moved.where("moved").limit(1).isEmpty():
            return roots


def spelling_groups(docs: DataFrame, o: Spelling | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of the texts.

    docs: (doc_id, text); other columns are not looked at.  A word is a maximal
    run of LETTERS (A-Z lowered, no other letter) of ``min_length`` code points
    that occurs ``min_count`` times; near words differ by exactly one inserted,
    deleted or replaced code point.  form: the near word with the largest n
    (ties: first in code-point order) if that is ``ratio`` times the word's own, else
    null; root: the last of its forms, the word itself without one.  A null or
    empty text has no words, a null id counts as an empty one, rows are counted
    one by one even where they are equal, a text or a run may have any length,
    and an empty table gives no rows.
    """
    o = o or Spelling()
    words = kept(word_counts(docs, o), "words")
    size = words.count()
    log = max(10, min(o.filter_bits.bit_length() - 1, (32 * max(1, size) - 1).bit_length()))
    found = candidates(words, _alphabet(words), o, _bit_set(words, log), log)
    vocabulary = words.select(F.col("word").alias("candidate"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("candidate").alias("word")))
    near = found.join(vocabulary, "candidate").groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    fit = -F.col("best.n") >= o.ratio * F.col("n")
    near = kept(near.select("word", "n_near", F.when(fit, F.col("best.word")).alias("form"), F.when(fit, -F.col("best.n")).alias("form_n")), "near")
    roots = _roots(near.where("form is not null"))
    return words.join(near, "word", "left").join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
