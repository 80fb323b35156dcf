"""Row digests and surrogate keys as built-in column expressions (JVM side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "<null>"


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def json_text(*cols) -> Column:
    """``to_json(struct(...))`` with explicit nulls: a null never shifts its neighbours."""
    return F.to_json(F.struct(*_cols(cols)), {"ignoreNullFields": "false"})


def delimited_text(*cols, sep: str = "|", null_token: str = NULL_TOKEN) -> Column:
    """``a|b|c`` with every null rendered as ``null_token`` (portable across SQL engines).

    Different rows have different texts: a backslash, the separator and the first character of ``null_token`` are
    escaped by a backslash inside values, so a value can neither end a part nor look like a null.
    """
    def escaped(c: Column) -> Column:
        text = c.cast("string")
        for mark in ("\\", sep, null_token[0]):
            text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
        return text

    return F.concat_ws(sep, *[F.coalesce(escaped(c), F.lit(null_token)) for c in _cols(cols)])


def row_digest(*cols, mode: str = "json") -> Column:
    """SHA-256 (lower hex) of a row's columns.

    ``mode="json"`` hashes the JSON rendering (names + explicit nulls); ``mode="text"`` hashes the delimited
    rendering, which other engines can reproduce byte for byte.
    """
    text = json_text(*cols) if mode == "json" else delimited_text(*cols)
    return F.sha2(text, 256)


def surrogate_key(**named) -> Column:
    """Deterministic key over named parts, e.g. ``surrogate_key(weather_code=..., precipitation_band=...)``."""
    parts = []
    for name, c in named.items():
        parts.extend([F.lit(name), F.col(c) if isinstance(c, str) else c])
    return F.sha2(F.to_json(F.named_struct(*parts), {"ignoreNullFields": "false"}), 256)


def version_id(prefix: str, hash_col, n: int = 12) -> Column:
    """Human-readable version id: ``prefix`` + first ``n`` hex characters of a content hash."""
    h = F.col(hash_col) if isinstance(hash_col, str) else hash_col
    return F.concat(F.lit(prefix), F.substring(h, 1, n))
