"""Byte-level BPE encoding and decoding by replaying merges over a corpus of words.

The distinct words of a batch lie in one array of symbols with links to their
neighbours.  An inverted index holds, for each merge rank, the places where its
pair stands.  Ranks are taken in order from a heap; all places of a rank merge
at once, and only the pairs at their two sides are looked up anew.  Where every
merge ranks after both of its parts, that order equals the order of merges in
each word alone; a word in which a merge turns out to rank lower is encoded by
itself instead, lowest rank first.

Texts are taken in steps of a few MB, and the words met so far are forgotten
when they pass a bound of number or bytes, so a task's memory follows neither
the texts nor the vocabulary of its partition.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textops as X
from .wordids import WordIds, gather

_NONE = np.int32(2**31 - 1)
#: Bytes of text that are taken at once; a longer text goes alone.
STEP = 4 << 20


class Tokens:
    """A rank file: tokens in base64 with their ranks."""

    def __init__(self, path: str):
        lines = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.bytes, self.starts[ids], self.lengths[ids]).tobytes()


class Merges(Tokens):
    """With the table of pairs that merge."""

    def __init__(self, path: str):
        super().__init__(path)
        self.byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        pairs = (
            x
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None
            for x in (left << 32 | right, rank)
        )
        table = np.fromiter(pairs, np.int64).reshape(-1, 2)
        table = table[np.argsort(table[:, 0])]
        self.keys, self.values = table[:, 0].copy(), table[:, 1].astype(np.int32)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, _NONE where they don't merge."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def alone(self, word: bytes) -> list[int]:
        """One word: merge the lowest rank, the first of equals, until none is left; n letters take n log n steps."""
        n = len(word)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at a letter; 0: no part begins there
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := self.ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != to:
                continue  # one of the two has merged since
            end[i], end[middle] = to, 0
            if to < n:
                before[to] = i
                if (rank := self.ranks.get(word[i : end[to]])) is not None:
                    heapq.heappush(heap, (rank, i, end[to]))
            if before[i] >= 0 and (rank := self.ranks.get(word[before[i] : to])) is not None:
                heapq.heappush(heap, (rank, before[i], to))
        return [self.ranks[word[i : end[i]]] for i in range(n) if end[i]]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after another, and how many each has."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        sym = self.byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(sym)
        if not n:
            return np.zeros(0, np.uint32), size
        end = np.cumsum(size)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[end[size > 0] - 1] = -1
        before[(end - size)[size > 0]] = -1
        now = np.full(n, _NONE, dtype=np.int32)  # the rank of the pair that begins here
        at = np.flatnonzero(after >= 0).astype(np.int32)
        now[at] = self.pair(sym[at], sym[after[at]])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray, rank: np.ndarray) -> None:
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, places in zip(rank[np.r_[0, cuts]].tolist(), np.split(at, cuts), strict=True):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(places)

        at = at[now[at] != _NONE]
        if len(at):
            add(at, now[at])
        odd: set[int] = set()  # words with a merge that ranks below one made before it
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            at = np.concatenate(places) if len(places) > 1 else places[0]
            at = at[now[at] == rank]
            if not len(at):
                continue
            if len(places) > 1:
                at = np.unique(at)
            if len(at) > 1 and (after[at[:-1]] == at[1:]).any():  # a run such as "aaa": leftmost first
                taken, last = [], -1
                for i in at.tolist():
                    if i != last:
                        taken.append(i)
                        last = after[i]
                at = np.array(taken, dtype=np.int32)
            gone = after[at]
            beyond = after[gone]
            sym[at], sym[gone] = rank, -1
            now[gone] = _NONE
            after[at] = beyond
            before[beyond[beyond >= 0]] = at[beyond >= 0]
            right, left = at[beyond >= 0], before[at]
            now[at] = _NONE
            touched = np.concatenate([right, left[left >= 0]])
            if len(touched):
                new = self.pair(sym[touched], sym[after[touched]])
                now[touched] = new
                touched, new = touched[new != _NONE], new[new != _NONE]
                if len(new):
                    if (new < rank).any():
                        odd.update(np.searchsorted(end, touched[new < rank], side="right").tolist())
                    add(touched, new)
        left = sym >= 0
        ids, count = sym[left].astype(np.uint32), X.per_row(left, np.r_[0, end])
        if odd:
            whole = np.split(ids, np.cumsum(count)[:-1])
            for w in odd:
                whole[w] = np.array(self.alone(words[w]), dtype=np.uint32)
                count[w] = len(whole[w])
            ids = np.concatenate(whole)
        return ids, count


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    ranks = merges(path)
    return WordIds(lambda words: ranks.replay([w.encode() for w in words]))


def _encoded(docs: DataFrame, ranks: str, pattern: str, text: str, decoded: bool) -> DataFrame:
    names = ["ids", "decoded"] if decoded else ["ids"]
    carried = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType([*carried, *(T.StructField(n, T.BinaryType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table, split = _word_ids(ranks), merges(ranks), regex.compile(pattern)

        def parts(value: str):
            # The words of a very long text are never all objects at once.
            return split.findall(value) if len(value) < STEP else (m[0] for m in split.finditer(value))

        for batch in batches:
            column = X.texts(batch.column(batch.schema.get_field_index(text)))
            for lo, hi in X.steps(column, STEP):
                numbers = [words.number(parts(x.as_py())) for x in column.slice(lo, hi - lo)]
                words.settle()
                for first in range(0, len(numbers), 256):
                    own = [batch.column(batch.schema.get_field_index(f.name)).slice(lo + first, len(numbers[first : first + 256])) for f in carried]
                    ids = [words.ids(x) for x in numbers[first : first + 256]]
                    made = [[x.tobytes() for x in ids]] + [[table.decode(x) for x in ids]] * decoded
                    yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, type=pa.binary()) for c in made)], names=[f.name for f in schema.fields])
                del numbers
                words.rest()
        words.clear()

    return docs.mapInArrow(X.tidied(run), schema)


def bpe_encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` added: the text's token ids as little-endian unsigned 32-bit integers.

    pattern splits a text into words that are encoded each by itself.  Null and
    empty texts have no ids.  A column ``ids`` of ``docs`` is replaced.  One
    pass without a shuffle; repeated rows each give a row; an empty table gives
    an empty one.
    """
    return _encoded(docs, ranks, pattern, text, False)


def bpe_round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` as by bpe_encode and ``decoded``, the bytes that bpe_decode would give for them, in one pass (columns of these names are replaced)."""
    return _encoded(docs, ranks, pattern, text, True)


def bpe_decode(encoded: DataFrame, ranks: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` added (a column of that name is replaced): the bytes that the ids stand for (null ids: null)."""
    carried = [f for f in encoded.schema.fields if f.name != "decoded"]
    schema = T.StructType([*carried, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tokens(ranks)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            for lo in range(0, batch.num_rows, 256):
                decoded = [None if x is None else table.decode(np.frombuffer(x, dtype=np.uint32)) for x in (v.as_buffer() for v in column.slice(lo, 256))]
                own = [batch.column(batch.schema.get_field_index(f.name)).slice(lo, 256) for f in carried]
                yield pa.RecordBatch.from_arrays([*own, pa.array(decoded, type=pa.binary())], names=[f.name for f in schema.fields])

    return encoded.mapInArrow(X.tidied(run), schema)
