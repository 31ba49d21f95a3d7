"""Quality rules on repetition: how much of a text lies inside repeated n-grams and lines.

Each text is a run of word hashes.  For several n the rolling hashes of all
n-word windows are compared within the text; a window found twice or more covers its
words, the first occurrence included.  The verdict compares the share of word
characters so covered, and the share of characters in lines that repeat an
earlier line, with a threshold for each n; symbols per word have a threshold
too.  No shuffle: one pass over the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textops as X

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of a rejection.  ``ngram_chars``: the largest share of word characters in repeated n-grams, by n (ascending)."""

    min_words: int = 50
    max_repeat_percent: int = 50
    ngram_chars: dict[int, float] = field(default_factory=lambda: {5: 0.40, 7: 0.35, 10: 0.30})
    line_chars: float = 0.30
    symbols_per_word: float = 0.25


FIELDS = [
    ("n_words", pa.int64(), T.LongType()),
    ("word_chars", pa.int64(), T.LongType()),
    ("n_symbols", pa.int64(), T.LongType()),
    ("n_dup_lines", pa.int64(), T.LongType()),
    ("n_repeat_words", pa.int64(), T.LongType()),
    ("dup_line_chars", pa.int64(), T.LongType()),
    ("dup_ngram_chars", pa.list_(pa.int64()), T.ArrayType(T.LongType())),
    ("base_failed", pa.bool_(), T.BooleanType()),
    ("kept", pa.bool_(), T.BooleanType()),
]


def measure(column: pa.Array, rules: QualityRules) -> dict[str, np.ndarray | list]:
    """The fields of FIELDS for one step of texts without nulls."""
    data, offsets = X.flat(column)
    rows = len(column)
    words = X.Words(data, offsets)
    points = (data & 0xC0) != 0x80
    out: dict = {"n_words": words.counts.astype(np.int64)}
    out["word_chars"] = X.per_row(points & words.is_word, offsets)
    out["n_symbols"] = X.per_row(_SYMBOL[data], offsets)

    at = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(points & words.is_word, out=at[1:])
    word_chars = at[words.end] - at[words.start]
    row = words.row
    salt = X.mix(np.arange(rows, dtype=np.uint64) + np.uint64(1))
    hashes = words.hashes()
    keyed = hashes ^ salt[row] if len(hashes) else hashes

    def covered(first: np.ndarray, n: int) -> np.ndarray:
        step = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(step, first, 1)
        np.add.at(step, first + n, -1)
        return np.cumsum(step)[:-1] > 0

    # Windows of more words can only repeat where the shorter ones do.
    rolling = X.Rolling(keyed)
    first = np.arange(len(hashes))
    first = first[first + 3 <= words.bounds[1:][row]]
    first = first[X.repeated(rolling.windows(first, 3))]
    out["n_repeat_words"] = X.per_row(covered(first, 3), words.bounds)
    spans = []
    for n in rules.ngram_chars:
        first = first[first + n <= words.bounds[1:][row[first]]]
        first = first[X.repeated(rolling.windows(first, n))]
        spans.append(X.per_row(np.where(covered(first, n), word_chars, 0), words.bounds))
    out["dup_ngram_chars"] = np.stack(spans, axis=1) if spans else np.zeros((rows, 0), np.int64)

    breaks = np.flatnonzero(data == 10)
    line_row = np.searchsorted(offsets, breaks, side="right") - 1
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    owner = np.sort(np.concatenate([np.arange(rows), line_row]), kind="stable")
    has_word = at[np.maximum(end, start)] > at[start]
    start, end, owner = start[has_word], end[has_word], owner[has_word]
    line_keys = X.hash_lines(data, start, end) ^ salt[owner] if len(start) else np.zeros(0, np.uint64)
    twice = np.flatnonzero(X.repeated(line_keys))
    order = twice[np.argsort(line_keys[twice], kind="stable")]
    later = order[1:][line_keys[order][1:] == line_keys[order][:-1]]
    out["n_dup_lines"] = np.bincount(owner[later], minlength=rows).astype(np.int64)
    line_chars = at[end[later]] - at[start[later]]
    out["dup_line_chars"] = np.bincount(owner[later], weights=line_chars, minlength=rows).astype(np.int64)

    failed = (out["n_words"] < rules.min_words) | (100 * out["n_repeat_words"] > rules.max_repeat_percent * out["n_words"])
    total = np.maximum(out["word_chars"], 1)
    good = ~failed & (out["dup_line_chars"] <= rules.line_chars * total) & (out["n_symbols"] <= rules.symbols_per_word * out["n_words"])
    for i, share in enumerate(rules.ngram_chars.values()):
        good &= out["dup_ngram_chars"][:, i] <= share * total
    out["base_failed"], out["kept"] = failed, good
    out["dup_ngram_chars"] = list(out["dup_ngram_chars"])
    return out


def quality(docs: DataFrame, rules: QualityRules | None = None, text: str = "text") -> DataFrame:
    """``docs`` with the columns of FIELDS added.

    A null text has no words and so fails, as an empty one does.  Texts of any
    length are measured whole.  Columns of ``docs`` that bear the name of an
    added one are replaced.  Repeated rows each give a row; an empty table
    gives an empty one.
    """
    rules = rules or QualityRules()
    names = {name for name, _, _ in FIELDS}
    carried = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType(carried + [T.StructField(name, kind) for name, _, kind in FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = X.texts(batch.column(batch.schema.get_field_index(text)))
            for lo, hi in X.steps(column):
                got = measure(column.slice(lo, hi - lo), rules)
                own = [batch.column(batch.schema.get_field_index(f.name)).slice(lo, hi - lo) for f in carried]
                made = [pa.array(got[name], type=kind) for name, kind, _ in FIELDS]
                yield pa.RecordBatch.from_arrays(own + made, names=[f.name for f in schema.fields])

    return docs.select(*dict.fromkeys([*(f.name for f in carried), text])).mapInArrow(X.tidied(run), schema)
