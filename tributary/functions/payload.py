"""Bronze payload text: pack typed rows to JSON and parse them back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.schemas import EVENT_COLUMNS, EVENT_SCHEMA


def pack(columns: list[str] = EVENT_COLUMNS) -> Column:
    """``to_json(struct(...))``; NULL fields are omitted, decimals keep scale."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]))


def parse(payload: str | Column = "payload") -> Column:
    """PERMISSIVE ``from_json`` with the fixed event schema.

    Malformed or truncated text yields a struct of NULLs; an amount that does
    not fit DECIMAL(12,2) yields only a NULL amount.
    """
    c = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(c, EVENT_SCHEMA)


def decode_value(value: str | Column = "value") -> Column:
    """Message bytes to payload text, checked: bytes that are no UTF-8 become U+FFFD (as does
    any reader's decoding), so Bronze holds valid text; a null value is the empty payload.
    Neither parses to a sale, or only with the damage visible, so such rows reach the DLQ."""
    c = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.make_valid_utf8(c.cast("string")), F.lit(""))


def parse_columns(df, keep: list[str], payload: str = "payload"):
    """``keep`` columns plus the five parsed fields, parsing each payload once.

    The parsed struct is expanded with ``inline``: a generator is a barrier
    for predicate pushdown, so later quality filters read the expanded
    columns instead of being rewritten into one ``from_json`` call per
    referenced field (which Catalyst does when a filter is pushed through a
    plain projection).  A NULL or malformed payload yields one row of NULLs.
    """
    return df.select(*keep, F.inline(F.array(parse(payload))))
