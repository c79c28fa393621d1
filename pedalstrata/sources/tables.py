"""Tables that are replaced together: prepared aside, switched in the catalog, put back on failure.

1. Prepare: rows and definition of every new table go under a name of their own. The write, the
   catalog and whatever reads the prepared rows may refuse; no table has changed by then.
2. Switch: the old table is renamed to a spare name and the prepared one takes its place. That moves
   no rows. If a step fails, all steps taken are undone, last first.
3. Clean up: spare tables and their rows go. They are no longer in use, so a failure here leaves
   spare rows behind and no wrong table.

A driver that dies inside the second phase can leave a table under its spare name only;
``recover`` puts that back, drops what else was left, and every load starts with it. Loads into one database must not overlap.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from pedalstrata.functions.casting import column, quoted
from pedalstrata.sources.staging import remove

log = logging.getLogger(__name__)

_SPARE = "__old_"
_NEW = "__new_"
_LEFT_BEHIND = re.compile(f"(.+)({_SPARE}|{_NEW})[0-9a-f]{{12}}")


class _Prepared(NamedTuple):
    table: str
    spare: str
    new: str
    path: str


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def _folder(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next((r.data_type for r in rows if r.col_name == "Location"), None)


def _drop(spark: SparkSession, table: str) -> None:
    """Definition and rows."""
    if spark.catalog.tableExists(table):
        path = _folder(spark, table)
        spark.sql(f"DROP TABLE {table}")
        if path:
            remove(spark, path)


def recover(spark: SparkSession, database: str) -> list[str]:
    """Clean up after a driver that died: every table that exists under a spare name alone gets its own
    name back; other spare and prepared tables go, with their rows. Returns the names given back."""
    names = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    restored = []
    for name in sorted(names):
        if not (found := _LEFT_BEHIND.fullmatch(name)):
            continue
        own, qualified = found[1], f"{database}.{quoted(name)}"
        if found[2] == _SPARE and own not in names:
            _rename(spark, qualified, f"{database}.{quoted(own)}")
            names.add(own)
            restored.append(own)
        else:
            _drop(spark, qualified)
    return restored


class TableLoad:
    """A load of any number of tables, to be used in a ``with`` block.

    ``add`` writes rows and returns them as stored; ``commit`` replaces all tables. Leaving the
    block without ``commit`` changes no table and removes what was prepared.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._run = uuid.uuid4().hex[:12]
        self._prepared: list[_Prepared] = []
        self._recovered: set[str] = set()

    def __enter__(self) -> TableLoad:
        return self

    def __exit__(self, *_: object) -> None:
        for p in self._prepared:
            self._discard(p)
        self._prepared = []

    def _discard(self, p: _Prepared) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {p.new}")
        remove(self.spark, p.path)

    def add(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Prepare a table. The frame may read the table that it will replace.

        What is returned reads the stored rows by their folder, before and after the switch.
        """
        spark = self.spark
        database, _, name = table.rpartition(".")
        database = database or spark.catalog.currentDatabase()
        if database not in self._recovered:
            recover(spark, database)
            self._recovered.add(database)
        home = spark.catalog.getDatabase(database).locationUri.rstrip("/")
        path = f"{home}/{name}-{self._run}"
        p = _Prepared(*[f"{database}.{quoted(n)}" for n in (name, f"{name}{_SPARE}{self._run}", f"{name}{_NEW}{self._run}")], path)
        if p.table in (q.table for q in self._prepared):
            raise ValueError(f"{table} is in this load already")
        # One shuffle sized by AQE instead of one small file per task and partition value.
        rows = df.hint("rebalance", *partition_by) if partition_by else df
        try:
            rows.write.partitionBy(*partition_by).saveAsTable(p.new, format="parquet", path=path)
            stored = spark.table(p.new)
            if {f.name for f in stored.schema} != set(df.columns):
                raise ValueError(f"the catalog holds other columns than {df.columns}")
        except Exception:
            self._discard(p)
            raise
        self._prepared.append(p)
        parted = spark.read.schema(stored.schema).parquet(path)
        return parted.select(*[column(c) for c in df.columns])

    def commit(self) -> None:
        """Replace all tables; on a failure none, and the error is raised."""
        spark, undo = self.spark, []
        try:
            for p in self._prepared:
                if spark.catalog.tableExists(p.table):
                    _rename(spark, p.table, p.spare)
                    undo.append((p.spare, p.table))
                _rename(spark, p.new, p.table)
                undo.append((p.table, p.new))
        except Exception:
            for now, before in reversed(undo):
                try:
                    _rename(spark, now, before)
                except Exception as e:  # noqa: BLE001 - the other tables still have to go back
                    log.error("%s could not go back to %s: %s", now, before, e)
            raise
        for p in self._prepared:
            spark.catalog.refreshTable(p.table)
            try:
                _drop(spark, p.spare)
            except Exception as e:  # noqa: BLE001 - the new tables are in place
                log.warning("rows of %s are left behind: %s", p.spare, e)
        self._prepared = []
