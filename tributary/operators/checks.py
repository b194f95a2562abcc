"""Table constraints (K13, K14) checked before a commit, in one pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.schemas import MONEY_SQL


class ConstraintViolation(Exception):
    pass


def money_beyond_range(c: str) -> Column:
    """Whether a value, of whatever numeric type or text, is none that DECIMAL(12,2) holds."""
    return F.col(c).isNotNull() & F.col(c).try_cast(MONEY_SQL).isNull()


def row_rules(not_null: Sequence[str] = (), varchar: Mapping[str, int] | None = None,
              money: Sequence[str] = ()) -> list[tuple[str, str, Column]]:
    """(rule, column, broken) for every rule that a row can break by itself."""
    return ([("not_null", c, F.col(c).isNull()) for c in not_null]
            + [(f"max_length_{n}", c, F.length(c) > n) for c, n in (varchar or {}).items()]
            + [("money_range", c, money_beyond_range(c)) for c in money])


def violations(df: DataFrame, table: str, *, key: Sequence[str] = (),
               not_null: Sequence[str] = (), varchar: Mapping[str, int] | None = None,
               money: Sequence[str] = (), examples: bool = False) -> DataFrame:
    """Rows ``(table_name, rule, column_name, n_violations)``, zero counts included; with
    ``examples`` (and a key) also ``example``, the least key that breaks the rule, as JSON text.

    The rows are read once.  The counters of all rules ride on the partial aggregate of the
    key, so a key that holds a third of the rows is one row a task in the only shuffle; the
    key's own rule counts its rows beyond the first.
    """
    rules = row_rules(not_null, varchar, money)
    labels = [(rule, c) for rule, c, _ in rules]
    broken = [F.count(F.when(test, 1)).alias(f"v{i}") for i, (_, _, test) in enumerate(rules)]
    if key:
        # places, not names: a column of the table may be called like a counter
        of_key = F.struct(*[F.col(c) for c in key])
        df = df.select(of_key.alias("key"), *[F.when(test, 1).alias(f"b{i}") for i, (_, _, test) in enumerate(rules)])
        df = df.groupBy("key").agg(*[F.count(f"b{i}").alias(f"v{i}") for i in range(len(rules))],
                                   (F.count(F.lit(1)) - 1).alias(f"v{len(rules)}"))
        labels.append(("unique_key", ",".join(key)))
        broken = [F.sum(f"v{i}").alias(f"v{i}") for i in range(len(labels))]
        if examples:
            broken += [F.min(F.when(F.col(f"v{i}") > 0, F.to_json("key"))).alias(f"e{i}") for i in range(len(labels))]
    elif examples:
        raise ValueError("examples are keys: name the key")
    schema = "table_name string, rule string, column_name string, n_violations long" + (", example string" if examples else "")
    if not labels:
        return df.sparkSession.createDataFrame([], schema)
    stacked = F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column_name"),
                 F.coalesce(F.col(f"v{i}"), F.lit(0)).cast("long").alias("n_violations"),
                 *([F.col(f"e{i}").alias("example")] if examples else []))
        for i, (rule, c) in enumerate(labels)]))
    return df.agg(*broken).select(F.lit(table).alias("table_name"), stacked)


def assert_valid(df: DataFrame, table: str, **rules) -> None:
    """Raise :class:`ConstraintViolation` naming every broken rule, with one key that breaks it."""
    named = bool(rules.get("key"))
    bad = [r for r in violations(df, table, examples=named, **rules).collect() if r["n_violations"] > 0]
    if bad:
        msg = "; ".join(f"{r['rule']}({r['column_name']})={r['n_violations']}"
                        + (f" such as {r['example']}" if named else "") for r in bad)
        raise ConstraintViolation(f"{table}: {msg}")
