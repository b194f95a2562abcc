"""Money column migration (K12): all tables or none.

Two shapes.  :func:`migrate_tables` rewrites snapshot tables whole.  :class:`MoneyTables` holds
several tables whose files are of two ages, money as DOUBLE in the old and as DECIMAL(12,2) in
the new ones: they read as one table of DECIMAL before, during and after the migration, new
rows may come in at any time between, and the migration rewrites the old files alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.checks import ConstraintViolation, violations
from tributary.operators.migrate import migrate_money, migration_report
from tributary.plans.tables import SnapshotTable
from tributary.schemas import MONEY_SQL

LAYOUT = "table_name string, path string, is_old boolean"


def migrate_tables(spark: SparkSession, tables: Mapping[str, tuple[SnapshotTable, Sequence[str]]]
                   ) -> DataFrame:
    """Rewrite every table's money columns as DECIMAL(12,2), then publish.

    Each new version is written and checked first; commit records are only
    appended after all writes succeeded, so a failure leaves every table on
    its old version.  Returns the per-column report (rounded / nulled).
    """
    staged, reports = [], []
    for name, (table, columns) in tables.items():
        before = table.read()
        reports.append(migration_report(before, name, list(columns)))
        staged.append((table, table.stage(migrate_money(before, list(columns)), "migrate-money")))
    report = reduce(DataFrame.unionByName, reports)
    report = spark.createDataFrame(report.collect(), report.schema)
    # Every new version is written; now commit them (one record write per log).
    by_log: dict[int, tuple] = {}
    for table, record in staged:
        by_log.setdefault(id(table.log), (table.log, []))[1].append(record)
    for log, records in by_log.values():
        log.commit(records)
    return report


class MoneyTables:
    """Tables of Parquet folders, each folder of one age; ``rules`` gives each table's ``money``
    columns and, optionally, its ``key``, ``not_null`` and ``varchar`` rules.

    Which folders are a table's is one small table of its own (``layout``, a row per folder),
    published atomically, so all tables change at once or none does.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, rules: Mapping[str, Mapping]):
        self.spark, self.root, self.rules = spark, root.rstrip("/"), dict(rules)
        self.layout = SnapshotTable(spark, f"{self.root}/layout", key=["path"], name="layout")

    def _folders(self) -> list[tuple[str, str, bool]]:
        return [] if self.layout.version() is None else [tuple(r) for r in self.layout.read().collect()]

    def _publish(self, folders: list[tuple[str, str, bool]], tag: str) -> None:
        self.layout.publish(self.spark.createDataFrame(folders, LAYOUT), tag=tag)

    def _write(self, name: str, df: DataFrame) -> str:
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def append(self, rows: Mapping[str, DataFrame]) -> None:
        """Adds rows to tables, all at once.  Files whose money is DOUBLE are old ones; a table's
        money columns are either all DOUBLE or all DECIMAL(12,2)."""
        added = []
        for name, df in rows.items():
            types = {dict(df.dtypes)[c] for c in self.rules[name]["money"]}
            if types not in ({"double"}, {MONEY_SQL}):
                raise TypeError(f"{name}: money must be all double or all {MONEY_SQL}, not {sorted(types)}")
            added.append((name, self._write(name, df), types == {"double"}))
        self._publish(self._folders() + added, "append")

    def _age(self, name: str, old: bool) -> DataFrame | None:
        paths = [path for table, path, is_old in self._folders() if table == name and is_old == old]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, name: str) -> DataFrame:
        """The table, money as DECIMAL(12,2): files of each age are a scan with their own schema
        (filters on the other columns reach both); an old value out of range fails the read."""
        old, new = self._age(name, True), self._age(name, False)
        if old is None and new is None:
            raise FileNotFoundError(f"table {name} has no rows")
        if old is not None:
            old = migrate_money(old, self.rules[name]["money"])
        return old.unionByName(new) if old is not None and new is not None else old if new is None else new

    def migrate(self) -> DataFrame:
        """Rewrites the old files of all tables; returns the report, a row per money column.

        Every old row is checked before any file is written, and the rules of every table are
        checked on what it will hold before the layout is published: a value out of range or a
        broken rule in one table leaves all as they were (files written are in no layout).
        """
        old = {name: rows for name in self.rules if (rows := self._age(name, True)) is not None}
        if not old:
            return self.spark.createDataFrame([], "table_name string, column_name string, n_rows long, n_rounded long, n_nulled long")
        report = reduce(DataFrame.unionByName, (migration_report(rows, name, self.rules[name]["money"]) for name, rows in old.items()))
        report = self.spark.createDataFrame(report.collect(), report.schema)  # a row per money column
        beyond = report.filter("n_nulled > 0").collect()
        if beyond:
            raise ConstraintViolation("out of range: " + "; ".join(f"{r['table_name']}.{r['column_name']}={r['n_nulled']}" for r in beyond))
        folders = [f for f in self._folders() if not f[2]]
        for name, rows in old.items():
            folders.append((name, self._write(name, migrate_money(rows, self.rules[name]["money"])), False))
        broken = []
        for name, rules in self.rules.items():
            kept = {rule: v for rule, v in rules.items() if rule in ("key", "not_null", "varchar") and v}
            paths = [path for table, path, _ in folders if table == name]
            if kept and paths:
                broken.append(violations(self.spark.read.parquet(*paths), name, **kept))
        bad = reduce(DataFrame.unionByName, broken).filter("n_violations > 0").collect() if broken else []
        if bad:
            raise ConstraintViolation("; ".join(f"{r['table_name']}: {r['rule']}({r['column_name']})={r['n_violations']}" for r in bad))
        self._publish(folders, "migrate-money")
        return report
