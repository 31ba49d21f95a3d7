"""Packing of tokenized documents into sequences of one length.

A document's ids are cut at multiples of the length.  Whole pieces fill a
sequence each.  The last piece of each document goes to one of a few open
groups at random; a group that has ``group`` pieces is packed: pieces are placed
in falling order of length into the first sequence with room (first-fit
decreasing), found by walking a tournament tree of the room left.  Groups lie
within a task, so ids are never shuffled, and are bounded and independent.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .wordids import WordIds, gather

#: What may follow a word as a piece of its own, and words it may follow: letters that no rule joins to it.
_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b not in b"'")
_LETTERS = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: Bytes of text that are taken at once; a longer text goes alone.
STEP = 8 << 20


class _Ids(WordIds):
    """Ids of texts by their words, A-Z lower-cased; a word of letters and the marks after it are encoded apart, each once.

    The tokenizer's special tokens are found in a text as it is, wherever they stand, and are one id each.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # text() has found them; in a lower-cased word they are ordinary text
        self.special: dict[str, int] = {}
        for number, token in self.tokenizer.get_added_tokens_decoder().items():
            if token.normalized or token.lstrip or token.rstrip or token.single_word:
                raise ValueError(f"the added token {token.content!r} is not found as it is")
            self.special[token.content] = number
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile(b"(" + b"|".join(re.escape(n.encode()) for n in names) + b")").split if names else None
        self.marks = {n.encode() for n in names}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            self.ends[[number for token, number in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.pieces = WordIds(self._encode, limit=400_000)
        super().__init__(self._split, limit=400_000)

    def text(self, data: bytes) -> np.ndarray:
        """The numbers of a text's words and special tokens; the latter are str among bytes."""
        if self.cut is not None and any(m in data for m in self.marks):
            parts = self.cut(data)
            return self.number(w for i, part in enumerate(parts) for w in ((part.decode(),) if i % 2 else part.lower().split()))
        return self.number(data.lower().split())

    def _each(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        found = [one.ids for one in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return list(itertools.chain.from_iterable(found)), list(map(len, found))

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces.  Where the tokenizer marks the ends of words, words of letters are encoded as one text and told apart by those."""
        flat, lengths, waiting = [], np.zeros(len(pieces), dtype=np.int64), []
        at: list[np.ndarray] = []
        for lo in range(0, len(pieces), 4096):
            texts = [p.decode() for p in pieces[lo : lo + 4096]]
            plain = [i for i, (p, t) in enumerate(zip(pieces[lo : lo + 4096], texts, strict=True)) if self.ends is not None and (p.isalpha() or _LETTERS.fullmatch(t))]
            lines = [" ".join(texts[i] for i in plain[k : k + 64]) for k in range(0, len(plain), 64)]
            ids = np.array(self._each(lines)[0] if lines else [], dtype=np.uint32)
            ends = np.flatnonzero(self.ends[ids]) if lines else np.zeros(0, np.int64)
            if len(ends) != len(plain):  # a letter whose lower case is more than one word
                plain, ids, ends = [], ids[:0], ends[:0]
            alone = sorted(set(range(len(texts))) - set(plain))
            more, sizes = self._each([texts[i] for i in alone]) if alone else ([], [])
            flat += (ids, np.array(more, dtype=np.uint32))
            at += (np.array(plain, dtype=np.int64) + lo, np.array(alone, dtype=np.int64) + lo)
            waiting += (np.diff(ends, prepend=-1), np.array(sizes, dtype=np.int64))
        order, sizes = np.concatenate(at), np.concatenate(waiting)
        lengths[order] = sizes
        starts = np.empty(len(pieces), dtype=np.int64)
        starts[order] = np.cumsum(sizes) - sizes
        return gather(np.concatenate(flat), starts, lengths), lengths

    def _split(self, words: list[bytes | str]) -> tuple[np.ndarray, np.ndarray]:
        self.pieces.rest()
        parts: list[bytes] = []
        counts: list[int] = []
        fixed: dict[int, int] = {}
        for word in words:
            if isinstance(word, str):
                fixed[len(counts)] = self.special[word]
                counts.append(0)
                continue
            core = word.rstrip(_MARKS)
            if core and len(core) < len(word) and (core.isalpha() or _LETTERS.fullmatch(core.decode())):
                parts += (core, word[len(core) :])
                counts.append(2)
            else:
                parts.append(word)
                counts.append(1)
        numbers = self.pieces.number(parts)
        self.pieces.settle()
        sizes = np.zeros(len(numbers) + 1, dtype=np.int64)
        np.cumsum(self.pieces.length[numbers], out=sizes[1:])
        ends = np.cumsum(np.array(counts, dtype=np.int64))
        flat, lengths = self.pieces.ids(numbers), sizes[ends] - sizes[ends - np.array(counts, dtype=np.int64)]
        if fixed:
            begins = np.cumsum(lengths) - lengths
            at = np.array(list(fixed))
            flat, lengths[at] = np.insert(flat, begins[at], list(fixed.values())), 1
        return flat, lengths


@lru_cache(maxsize=2)
def _word_ids(path: str) -> _Ids:
    return _Ids(path)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its place there; pieces of equal length in their given order."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)  # room[i]: the most room of any bin below node i
    bins, places = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], places[i] = node - leaves, capacity - room[node]
        room[node] -= size
        node //= 2
        while node:
            room[node] = max(room[2 * node], room[2 * node + 1])
            node //= 2
    return bins, places


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, group: int = 4096, key: str = "doc_id", text: str = "text", opened: int = 4) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    path: a tokenizer file whose tokenizer lower-cases, and treats words between
    white space, and letters and marks within them, on their own; special
    tokens that stand in a text count as such.  Every document ends with
    ``end_id``; a null or empty text is that id alone.  Each id lies in one
    piece, and a sequence's pieces follow each other without a gap.  Repeated
    rows are packed each by itself; a null id stays null; no documents give no
    pieces; other columns are not looked at.

    A task packs the documents of its own partition, of which ``opened`` groups
    of at most ``group`` last pieces are held.  Partitions of fewer than some
    hundred documents leave more padding, one part-filled sequence or so each.
    """
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, made, seen = _word_ids(path), TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], dtype=np.uint32)
        groups: list[list[tuple]] = [[] for _ in range(opened)]

        def rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(found), 1024):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*found[lo : lo + 1024], strict=True), kinds, strict=True)], names=names)

        def packed(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            bins, places = first_fit_decreasing(np.array([p[2] for p in pieces]), capacity)
            first = (task << 40) + made
            made += int(bins.max()) + 1
            yield from rows([(*p, first + b, o) for p, b, o in zip(pieces, bins.tolist(), places.tolist(), strict=True)])

        for batch in batches:
            column = X.texts(batch.column(1))
            for lo, hi in X.steps(column, STEP):
                numbers = [words.text(x.as_buffer().to_pybytes()) for x in column.slice(lo, hi - lo)]
                words.settle()
                whole: list[tuple] = []
                for doc, x in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), numbers, strict=True):
                    ids = np.concatenate([words.ids(x), end])
                    last = len(ids) // capacity * capacity
                    for start in range(0, last, capacity):
                        whole.append((doc, start, capacity, ids[start : start + capacity].tobytes(), len(ids), (task << 40) + made, 0))
                        made += 1
                    if len(whole) >= 1024:
                        yield from rows(whole)
                        whole = []
                    if last < len(ids):
                        own = groups[int(X.mix(np.array([seen + (task << 40)], dtype=np.uint64))[0] >> np.uint64(32)) % opened]
                        seen += 1
                        own.append((doc, last, len(ids) - last, ids[last:].tobytes(), len(ids)))
                        if len(own) == group:
                            yield from packed(own)
                            own.clear()
                yield from rows(whole)
                del numbers
                words.rest()
        words.clear()
        words.pieces.clear()
        # What is left is dealt anew, so that a task ends with as few part-filled groups as it can.
        left = [p for own in groups for p in own]
        parts = max(1, -(-len(left) // group))
        for i in range(parts):
            if left[i::parts]:
                yield from packed(left[i::parts])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(X.tidied(run), schema)
