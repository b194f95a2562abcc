"""Money column migration (K12): double -> DECIMAL(12,2) with a change report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.quality import money
from tributary.schemas import MONEY_SQL


def migrate_money(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Same rows, the given columns cast to DECIMAL(12,2); a value out of range fails the
    migration (as an ``ALTER`` would), it is never blanked."""
    def cast(c: str) -> Column:
        beyond = F.raise_error(F.concat(F.lit(f"{c} out of range: "), F.col(c).cast("string"))).cast(MONEY_SQL)
        return F.when(F.col(c).isNotNull(), F.coalesce(money(c), beyond)).alias(c)
    return df.select(*[cast(c) if c in columns else F.col(c) for c in df.columns])


def migration_report(before: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, values changed by rounding, values nulled by range.

    One aggregation over the old table; run it before publishing the new one.
    """
    aggs = []
    for c in columns:
        new = money(c)
        aggs += [
            F.count(F.lit(1)).alias(f"{c}__rows"),
            F.sum(F.when(F.col(c).isNotNull() & new.isNotNull()
                         & (new.cast("double") != F.col(c).cast("double")), 1).otherwise(0))
            .alias(f"{c}__rounded"),
            F.sum(F.when(F.col(c).isNotNull() & new.isNull(), 1).otherwise(0)).alias(f"{c}__nulled"),
        ]
    row = before.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.col(f"{c}__rows").cast("long").alias("n_rows"),
                 F.coalesce(F.col(f"{c}__rounded"), F.lit(0)).cast("long").alias("n_rounded"),
                 F.coalesce(F.col(f"{c}__nulled"), F.lit(0)).cast("long").alias("n_nulled"))
        for c in columns]))
    return row.select(stacked.alias("s")).select(F.lit(table).alias("table_name"), "s.*")
