"""Tables with a primary key: bucketed and sorted by it, replaced version by version.

The key is the bucketing of the table, so the current rows and a batch of
changes, bucketed alike, are merged bucket by bucket: the merge has no exchange
and a row is moved only if it changed. Every merge writes a new version next to
the current one; a catalog view under the table's name says which version that
is. Readers name the view, and the switch is one catalog operation: they see
the rows of before or of after, also when the job dies between write and switch.
A version that no view names is removed by ``vacuum``.

One writer at a time: a switch is refused when the view has moved on since the
merge began.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import latest_per_key
from ..session import remove_path, scratch_path

_PROPERTY = "tessera."


class KeyedTable:
    """``KeyedTable.create`` defines a table, ``KeyedTable(spark, name)`` opens one of the catalog."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        of = {r["key"][len(_PROPERTY):]: r["value"] for r in rows if r["key"].startswith(_PROPERTY)}
        self.keys, self.buckets, self.columns = of["keys"].split(","), int(of["buckets"]), of["columns"]
        self.location = of["location"]

    @classmethod
    def create(cls, spark: SparkSession, name: str, columns: str, keys: list[str], buckets: int | None = None,
               location: str | None = None) -> KeyedTable:
        """An empty table. ``columns`` is the column list of a CREATE TABLE; ``location`` a shared folder for its versions."""
        table = cls.__new__(cls)
        table.spark, table.name, table.keys, table.columns = spark, name, list(keys), columns
        table.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        table.location = location or scratch_path(spark, f"keyed-{name}")
        table._switch(table._define(), before=None)
        return table

    def _define(self, kind: str = "v") -> str:
        """A new, empty version: the table definition, with the key as its bucketing."""
        version = f"{self.name}__{kind}{uuid.uuid4().hex}"
        key = ", ".join(self.keys)
        self.spark.sql(f"""
            CREATE TABLE {version} ({self.columns}) USING parquet
            CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS
            LOCATION '{self.location}/{version}'
            TBLPROPERTIES ('{_PROPERTY}primary_key' = '{",".join(self.keys)}')""")
        return version

    def _switch(self, version: str, before: str | None) -> None:
        """Let the name stand for ``version`` from now on."""
        if before is not None and self.current() != before:
            raise RuntimeError(f"{self.name} was replaced by another writer")
        properties = {"current": version, "keys": ",".join(self.keys), "buckets": str(self.buckets),
                      "columns": self.columns, "location": self.location}
        listed = ", ".join(f"'{_PROPERTY}{k}' = '{v}'" for k, v in properties.items())
        create = "CREATE VIEW" if before is None else "CREATE OR REPLACE VIEW"
        self.spark.sql(f"{create} {self.name} TBLPROPERTIES ({listed}) AS SELECT * FROM {version}")

    def current(self) -> str:
        """The version that the name stands for."""
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.name} ('{_PROPERTY}current')").first()["value"]

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def _checked(self, column: str) -> Column:
        kind = self.rows().schema[column].dataType
        return F.coalesce(F.col(column), F.raise_error(F.lit(f"null in key column {column} of {self.name}")).cast(kind)).alias(column)

    def merged(self, current: str, delta: str, version: str | None) -> DataFrame:
        """The rows of ``current`` with those of ``delta`` put over them (both bucketed by the key: no exchange)."""
        old, new = self.spark.table(current).alias("old"), self.spark.table(delta).alias("new")
        there = F.col(f"new.{self.keys[0]}").isNotNull()
        if version:
            before, after = F.col(f"old.{version}"), F.col(f"new.{version}")
            there &= F.col(f"old.{self.keys[0]}").isNull() | before.isNull() | F.coalesce(after >= before, F.lit(False))
        on = None
        for k in self.keys:
            same = F.col(f"old.{k}") == F.col(f"new.{k}")
            on = same if on is None else on & same
        columns = [F.coalesce(f"old.{c}", f"new.{c}").alias(c) if c in self.keys else
                   F.when(there, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in self.rows().columns]
        return old.hint("merge").join(new, on, "full_outer").select(*columns)

    def upsert(self, changes: DataFrame, version: str | None = None) -> None:
        """Put ``changes`` in: a new key adds a row, a known one replaces it.

        With ``version`` the row with the greater value of that column stays; at
        equal values the change does. Of several changes of one key the one
        with the greatest version, then the greatest other columns, counts.
        A null in a key column fails the job and leaves the table as it was.
        """
        before = self.current()
        columns = self.rows().columns
        others = [c for c in columns if c not in self.keys]
        rows = changes.select(*[self._checked(c) if c in self.keys else F.col(c) for c in columns])
        if others:  # partial aggregates first: a key with many changes is no hot key of the exchange
            rows = latest_per_key(rows, self.keys, version or others[0]).select(*columns)
        else:
            rows = rows.distinct()
        delta = self._define("delta")
        rows.repartition(self.buckets, *self.keys).write.insertInto(delta)
        after = self._define()
        self.merged(before, delta, version).write.insertInto(after)
        self._switch(after, before)
        self._drop(delta)

    def _drop(self, version: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {version}")
        remove_path(self.spark, f"{self.location}/{version}")

    def vacuum(self) -> None:
        """Remove all versions but the current one, also those of merges that never ended."""
        current = self.current()
        for r in self.spark.sql(f"SHOW TABLES LIKE '{self.name}__*'").collect():
            if r["tableName"] != current:
                self._drop(r["tableName"])

    def drop(self) -> None:
        """Remove the table with all versions."""
        self.vacuum()
        current = self.current()
        self.spark.sql(f"DROP VIEW {self.name}")
        self._drop(current)
