"""Several date-partitioned Parquet tables that change together.

A refresh writes only the partitions it changes, each below a new generation's folder, and then one small
table that names, for every table and date, the generations that hold its rows.  Readers take the last
such table that is complete, so they see all of a refresh or nothing of it, also while the next one runs
or after one that failed.  Work that was never committed is not read.  A table's columns are stored with
it; a later generation may append columns, and rows written before have null there.

The list has one row for each table, date and generation; only that list reaches the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LIST_SCHEMA = "table_name string, date_column string, columns string, date string, generation long"


def _children(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def with_appended(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The old columns, then those that are new; a column that changes its type is an error."""
    if old is None:
        return new
    known = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if known.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} was {known[f.name].simpleString()} and is {f.dataType.simpleString()}")
    return T.StructType(old.fields + [f for f in new.fields if f.name not in known])


class Generation:
    """One change of the tables below root: read, replace and append, then commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        done = [int(x.split("=")[1]) for x in _children(spark, f"{self.root}/_lists")
                if x.startswith("generation=") and "_SUCCESS" in _children(spark, f"{self.root}/_lists/{x}")]
        self.base = max(done, default=None)
        self.number = (self.base or 0) + 1
        self.columns: dict[str, T.StructType] = {}
        self.date_column: dict[str, str] = {}
        self.places: dict[str, dict[str, list[int]]] = {}
        if self.base is not None:
            for r in spark.read.schema(LIST_SCHEMA).parquet(f"{self.root}/_lists/generation={self.base}").collect():
                self.columns[r.table_name] = T.StructType.fromJson(json.loads(r["columns"]))
                self.date_column[r.table_name] = r.date_column
                dates = self.places.setdefault(r.table_name, {})
                if r.date is not None:
                    dates.setdefault(r.date, []).append(r.generation)

    def dates(self, table: str) -> set[str]:
        return set(self.places.get(table, {}))

    def read(self, table: str, dates: set[str] | None = None) -> DataFrame:
        """The table as it will be, or only the given dates of it (other files aren't opened)."""
        columns, column = self.columns[table], self.date_column[table]
        paths = [f"{self.root}/{table}/generation={g}/{column}={d}" for d, gs in sorted(self.places[table].items())
                 if dates is None or d in dates for g in gs]
        if not paths:
            return self.spark.createDataFrame([], columns)
        found = self.spark.read.schema(columns).option("basePath", f"{self.root}/{table}").parquet(*paths)
        return found.select(*columns.fieldNames())

    def append(self, table: str, df: DataFrame, date_column: str, cluster_by: tuple[str, ...] = (), dropping: set[str] = frozenset(),
               rebalance: bool = True) -> set[str]:
        """Writes rows, after taking the dates in dropping out of the table; returns the dates written."""
        from touchline.sources.sinks import write_clustered

        if any(self.number in gs for gs in self.places.get(table, {}).values()):
            raise ValueError(f"{table} is already written in this generation")
        columns = with_appended(self.columns.get(table), df.schema)
        write_clustered(df, f"{self.root}/{table}/generation={self.number}", date_column, cluster_by, mode="overwrite", rebalance=rebalance)
        written = {x.split("=", 1)[1] for x in _children(self.spark, f"{self.root}/{table}/generation={self.number}") if x.startswith(f"{date_column}=")}
        places = {d: list(gs) for d, gs in self.places.get(table, {}).items() if d not in dropping}
        for d in written:
            places.setdefault(d, []).append(self.number)
        self.places[table], self.columns[table], self.date_column[table] = places, columns, date_column
        return written

    def replace(self, table: str, df: DataFrame, date_column: str, dates: set[str] | None = None, cluster_by: tuple[str, ...] = (),
                rebalance: bool = True) -> set[str]:
        """Writes rows in place of the given dates, or of all."""
        return self.append(table, df, date_column, cluster_by, self.dates(table) if dates is None else dates, rebalance)

    def commit(self) -> int:
        """Makes everything written visible at once."""
        rows = []
        for table, dates in self.places.items():
            head = (table, self.date_column[table], self.columns[table].json())
            rows += [(*head, d, g) for d, gs in dates.items() for g in gs] or [(*head, None, None)]
        # A generation that another run committed meanwhile makes this an error: the folder exists.
        self.spark.createDataFrame(rows, LIST_SCHEMA).coalesce(1).write.mode("error").parquet(f"{self.root}/_lists/generation={self.number}")
        return self.number
