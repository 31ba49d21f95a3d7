"""String rules: tokens, identifiers, rendering (STR-01..15, JSN-02)."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no meaning in a column's comment.
COMMENT_STOPWORDS = ("the", "of", "and", "a", "an", "to", "for", "id", "column", "table")
# Words that carry no meaning in a question.
QUESTION_STOPWORDS = (
    "a", "an", "the", "in", "on", "of", "by", "to", "for", "from", "and", "or", "is", "are", "that", "this", "with", "what", "how", "where", "which", "all", "each", "many",
    "have", "has", "out", "who", "show", "list", "get", "find", "do", "did", "does", "per", "avg", "sum", "any", "its", "be", "been",
)
# Statements that a read-only query may not contain.
FORBIDDEN_SQL = (
    "alter", "call", "copy", "create", "delete", "drop", "execute", "grant", "insert", "merge", "msck", "optimize", "refresh", "repair", "replace", "revoke", "truncate", "update", "use", "vacuum",
)


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def comment_tokens(comment: Column | str) -> Column:
    """STR-04, ARR-02: alphanumeric runs of four characters or more that are no stopwords, in order, repeated ones too."""
    long_stop = [w for w in COMMENT_STOPWORDS if len(w) >= 4]  # shorter ones are no runs of four
    runs = rf"(?<![a-z0-9])(?!(?:{'|'.join(long_stop)})(?![a-z0-9]))[a-z0-9]{{4,}}"
    return F.regexp_extract_all(F.lower(F.coalesce(_col(comment), F.lit(""))), F.lit(runs), F.lit(0))


def question_tokens(question: Column | str) -> Column:
    """STR-05: distinct letter runs of three characters or more, lower case, no stopwords, in order."""
    stop = F.array(*map(F.lit, QUESTION_STOPWORDS))
    runs = F.regexp_extract_all(F.lower(F.coalesce(_col(question), F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    return F.array_distinct(F.filter(runs, lambda t: (F.length(t) >= 3) & ~F.array_contains(stop, t)))


def sanitize_identifier(name: Column | str, prefix: str = "t") -> Column:
    """STR-06: other characters become one ``_``; none at the ends; lower case; a leading digit gets the prefix."""
    clean = F.lower(F.regexp_replace(F.regexp_replace(_col(name), "[^a-zA-Z0-9_]+", "_"), "^_+|_+$", ""))
    return F.when(clean.rlike("^[0-9]"), F.concat(F.lit(prefix + "_"), clean)).otherwise(clean)


def schema_name(source: Column | str) -> Column:
    """STR-07 without de-duplication: no ``.sql``, other characters ``_``, in front ``sp_``."""
    clean = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(_col(source), r"(?i)\.sql$", ""), "[^a-zA-Z0-9]+", "_"), "^_+|_+$", ""))
    return F.concat(F.lit("sp_"), clean)


def constraint_name(prefix: str, *parts: Column, limit: int = 255) -> Column:
    """STR-10: prefix_a__b; beyond the limit cut, with twelve digits of the whole name's sha1."""
    kept = [F.when(p != "", p) for p in map(_col, parts)]
    body = F.concat_ws("__", *kept)
    name = F.when(body != "", F.concat(F.lit(prefix + "_"), body)).otherwise(F.lit(prefix))
    keep = limit - len(prefix) - 1 - 12 - 1
    short = F.concat(F.lit(prefix + "_"), F.substring(name, len(prefix) + 2, keep), F.lit("_"), F.substring(F.sha1(name), 1, 12))
    return F.when(F.length(name) <= limit, name).otherwise(short)


def sql_literal(value: Column | str) -> Column:
    """STR-09: NULL, or the value in quotes with quotes doubled and backslashes escaped."""
    text = F.replace(F.replace(_col(value).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    return F.when(text.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), text, F.lit("'")))


def short_value(value: Column | str, most: int = 80) -> Column:
    """STR-13: a longer value is cut to ``most`` characters and ``...``."""
    value = _col(value)
    return F.when(F.length(value) > most, F.concat(F.substring(value, 1, most), F.lit("..."))).otherwise(value)


def cell_text(value: Column | str) -> Column:
    """STR-14: a cell for comparing results: lower-case text, ``NULL`` for null."""
    return F.coalesce(F.lower(_col(value).cast("string")), F.lit("NULL"))


def parse_sql(text: Column | str) -> Column:
    """STR-11: a struct of the SQL without its code fence (null if nothing is left) and whether it starts as a statement."""
    cleaned = F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"^\s+|\s+$", "")
    fence = r"(?is)^```(?:sql)?\s*\n?(.*?)\n?```\s*$"
    inner = F.when(cleaned.rlike(fence), F.regexp_replace(F.regexp_extract(cleaned, fence, 1), r"^\s+|\s+$", "")).otherwise(cleaned)
    return F.struct(F.when(inner != "", inner).alias("sql"), inner.rlike(r"(?i)^(SELECT|WITH|INSERT|UPDATE|DELETE|CREATE|EXPLAIN)\b").alias("valid"))


def first_table(sql: Column | str, place: int) -> Column:
    """STR-15: catalog (1), schema (2) or table (3) of the first name written `c`.`s`.`t`; null without one."""
    part = F.regexp_extract(_col(sql), r"`([^`]+)`\.`([^`]+)`\.`([^`]+)`", place)
    return F.when(part != "", part)


def generated_text(response: Column | str) -> Column:
    """JSN-02: the text in a model's JSON answer, whichever of the usual shapes it has."""
    paths = ("$.choices[0].message.content", "$.choices[0].text", "$.message.content", "$.content[0].text", "$.content", "$.result", "$.predictions[0].content", "$.predictions[0]", "$.output_text", "$.text")
    return F.coalesce(*[F.get_json_object(_col(response), p) for p in paths])


def json_block(text: Column | str) -> Column:
    """JSN-01: the first ``[{...}]`` block of a text; null without one."""
    block = F.regexp_extract(_col(text), r"(?s)(\[\s*\{.*\}\s*\])", 1)
    return F.when(block != "", block)


def split_statements(script: str) -> list[str]:
    """STR-12: the statements of a SQL script; quotes and ``--`` comments are respected, comments alone are dropped."""
    piece = re.compile(r"'(?:[^']|'')*'?|\"(?:[^\"]|\"\")*\"?|`[^`]*`?|--[^\n]*|;|[^'\"`;-]+|-")
    out, part, solid = [], [], False
    for m in piece.finditer(script):
        token = m[0]
        if token == ";":
            if solid:
                out.append("".join(part).strip())
            part, solid = [], False
            continue
        part.append(token)
        solid |= not token.startswith("--") and bool(token.strip())
    if solid:
        out.append("".join(part).strip())
    return out


_IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_-]*$")


def validate_identifier(value: str, label: str = "identifier") -> str:
    """STR-08: the value, if it may stand between backticks without escapes."""
    if not _IDENTIFIER.match(value):
        raise ValueError(f"not a valid {label}: {value!r}")
    return value


def quoted_name(name: str, parts: int | None = None) -> str:
    """STR-08: a dotted name with each valid part in backticks."""
    pieces = name.split(".")
    if parts is not None and len(pieces) != parts:
        raise ValueError(f"{name!r} doesn't have {parts} parts")
    return ".".join(f"`{validate_identifier(p)}`" for p in pieces)


def response_key(endpoint: str, arm: str, prompts: list[str]) -> str:
    """SNK-12: the cache key of a batch of prompts."""
    return hashlib.sha256("\x1f".join([endpoint, arm, *prompts]).encode()).hexdigest()
