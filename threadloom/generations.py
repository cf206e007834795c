"""Replacing several tables at once, by one switch that every reader sees whole or not at all.

Below a path, each write of a table is a folder of its own in ``_versions``, and a small file in
``_generations`` names the folder of every table. The file with the highest number is the pointer:
a job writes all its tables first and then one file, under another name until it is complete.
Nothing is renamed but that file, so data is never moved, in stores without renames either.
Readers find a table's folder with :func:`current_path`, as ``sources.read_table`` does.

In a catalog, every write of a table is a partition of ``<table>_versions``; the view
``current_versions`` has a column for each table with the version to read, and the table itself is a
view that reads that partition. Replacing ``current_versions`` is one statement and switches all.

What a run leaves behind, finished or broken off, goes when the next one starts: versions that the
pointer does not name. So the tables of the run before stay readable for queries that began on
them. One run at a time may write below a path or into a database.

A write may put rows aside: rows that are not the table's, and that a later step of the same run
wants. They go to a folder or partition of their own in the same pass, until the run drops them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.session import file_system, unsorted_writes

POINTERS, VERSIONS = "_generations", "_versions"
CATALOG_POINTER = "current_versions"
VERSION = "version"
# The folder level that parts the rows of a table from those put aside.
OUTCOME, ROWS, ASIDE = "outcome", "rows", "aside"


def _is_aside(aside: T.StructType) -> Column:
    """Rows put aside are those with a value in a column that the table doesn't have."""
    return F.coalesce(*(F.col(c).cast("string") for c in aside.names)).isNotNull()


def _numbered_pointers(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """Numbers and paths of the pointer files, the current one last."""
    folder = f"{base.rstrip('/')}/{POINTERS}"
    system, path = file_system(spark, folder)
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path)]
    numbers = [n.removesuffix(".json") for n in names if n.endswith(".json")]
    return sorted((int(n), f"{folder}/{n}.json") for n in numbers if n.isdigit())


def _named(spark: SparkSession, base: str) -> dict[str, str]:
    """The tables that the pointer names, with their folders below ``_versions``."""
    pointers = _numbered_pointers(spark, base)
    if not pointers:
        return {}
    system, path = file_system(spark, pointers[-1][1])
    stream = system.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)["tables"]


def current_paths(spark: SparkSession, base: str) -> dict[str, str]:
    """The folder of every table below ``base`` that was replaced by a switch."""
    root = f"{base.rstrip('/')}/{VERSIONS}"
    return {table: f"{root}/{name}" for table, name in _named(spark, base).items()}


def current_path(spark: SparkSession, base: str, table: str) -> str:
    """The folder to read a table from: the pointer's, or a plain folder that no switch replaced."""
    return current_paths(spark, base).get(table, f"{base.rstrip('/')}/{table}")


class PathGeneration:
    """Tables below ``base`` that are replaced together."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.mark = uuid.uuid4().hex
        self.staged: dict[str, str] = {}
        self.plain: list[str] = []

    def path(self, table: str) -> str:
        """Where the new table is."""
        return f"{self.base}/{VERSIONS}/{self.staged[table]}"

    def tidy(self) -> None:
        """Remove what the pointer does not name: versions, older pointers, unfinished ones."""
        pointers = _numbered_pointers(self.spark, self.base)
        named = {name.split("/")[0] for name in _named(self.spark, self.base).values()}
        kept = {path.rsplit("/", 1)[1] for _, path in pointers[-1:]}
        for folder, keep in ((VERSIONS, named), (POINTERS, kept)):
            system, path = file_system(self.spark, f"{self.base}/{folder}")
            for status in system.listStatus(path) if system.exists(path) else []:
                if status.getPath().getName() not in keep:
                    system.delete(status.getPath(), True)

    def _version(self, table: str) -> str:
        """The folder that one write of a table made, with what it put aside."""
        return f"{self.base}/{VERSIONS}/{self.staged[table].split('/')[0]}"

    def _delete(self, folder: str) -> None:
        system, path = file_system(self.spark, folder)
        system.delete(path, True)

    def _read(self, folder: str, schema: T.StructType) -> DataFrame:
        """A folder's rows; Spark writes no folder for a part without rows."""
        system, path = file_system(self.spark, folder)
        if not system.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def stage(
        self,
        df: DataFrame,
        table: str,
        kind: str | None = None,
        check: Callable[[], None] | None = None,
        aside: T.StructType | None = None,
    ) -> None:
        """Write a new table that nobody reads before the switch. With ``aside``, columns that the
        table doesn't have, rows with a value in one of them are put aside."""
        self.staged[table] = f"{table}-{self.mark}"
        if aside is None:
            df.write.parquet(self.path(table))
        else:
            version = self._version(table)
            self.staged[table] += f"/{OUTCOME}={ROWS}"
            outcome = F.when(_is_aside(aside), ASIDE).otherwise(ROWS)
            with unsorted_writes(self.spark):
                df.withColumn(OUTCOME, outcome).write.partitionBy(OUTCOME).parquet(version)
            system, path = file_system(self.spark, self.path(table))
            if not system.exists(path):
                self.spark.createDataFrame([], df.schema).write.parquet(self.path(table))
        if check:
            check()

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The new table, before the switch."""
        return self.spark.read.schema(schema).parquet(self.path(table))

    def read_aside(self, table: str, schema: T.StructType) -> DataFrame:
        """What the table's write put aside."""
        return self._read(f"{self._version(table)}/{OUTCOME}={ASIDE}", schema)

    def drop_aside(self, table: str) -> None:
        """Remove what the table's write put aside."""
        self._delete(f"{self._version(table)}/{OUTCOME}={ASIDE}")

    def publish(self, table: str) -> None:
        """Copy the table to a plain folder too, after the switch, for readers that go by path."""
        self.plain.append(table)

    def _point(self, number: int, tables: dict[str, str]) -> None:
        """Write pointer ``number``: complete under another name, then visible by one rename."""
        target = f"{self.base}/{POINTERS}/{number:012d}.json"
        system, draft = file_system(self.spark, f"{self.base}/{POINTERS}/{self.mark}.draft")
        _, final = file_system(self.spark, target)
        stream = system.create(draft, False)
        stream.write(bytearray(json.dumps({"tables": tables}).encode()))
        stream.close()
        if system.exists(final) or not system.rename(draft, final):
            raise OSError(f"another run has written {target}")

    def switch(self) -> None:
        """Show all new tables at once; tables that were not written stay as they are."""
        pointers = _numbered_pointers(self.spark, self.base)
        tables = _named(self.spark, self.base) | self.staged
        self._point(pointers[-1][0] + 1 if pointers else 1, tables)
        for table in self.plain:
            self.spark.read.parquet(self.path(table)).write.mode("overwrite").parquet(f"{self.base}/{table}")

    def give_up(self) -> None:
        """Remove what was written; the tables stay as they were."""
        for table in self.staged:
            self._delete(self._version(table))


class CatalogGeneration:
    """Tables of a database that are replaced together."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        self.mark = uuid.uuid4().hex
        self.staged: dict[str, str] = {}
        self.columns: dict[str, list[str]] = {}

    def _current(self) -> dict[str, str | None]:
        name = f"{self.database}.{CATALOG_POINTER}"
        if not self.spark.catalog.tableExists(name):
            return {}
        return self.spark.table(name).first().asDict()

    def _forget(self, versions: str, mark: str) -> None:
        """Remove one version of a table."""
        where = f"{self.database}.{versions}"
        try:
            self.spark.sql(f"ALTER TABLE {where} DROP IF EXISTS PARTITION ({VERSION} = '{mark}')")
        except AnalysisException:
            # a catalog that keeps no partitions finds them by their folders
            described = self.spark.sql(f"DESCRIBE FORMATTED {where}").where("col_name = 'Location'")
            folder = described.first()["data_type"]
            system, path = file_system(self.spark, f"{folder}/{VERSION}={mark}")
            system.delete(path, True)
            self.spark.sql(f"REFRESH TABLE {where}")

    def tidy(self) -> None:
        """Remove versions that the pointer does not name, and tables of the layout before."""
        kept = set(self._current().values())
        for table in self.spark.catalog.listTables(self.database):
            if table.name.endswith("_versions") and table.tableType != "VIEW":
                marks = self.spark.table(f"{self.database}.{table.name}").select(VERSION).distinct()
                for row in marks.where(~F.col(VERSION).isin(*kept)).collect() if kept else marks.collect():
                    self._forget(table.name, row[VERSION])
            elif table.name.endswith("_former") and kept:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{table.name}")

    def _fitted(self, df: DataFrame, versions: str) -> DataFrame:
        """The rows with all columns of the stored versions, which get those that only the rows
        have: some writes put rows aside and others don't."""
        if not self.spark.catalog.tableExists(versions):
            return df
        stored = self.spark.table(versions).drop(VERSION).schema
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in stored.names]
        if new:
            self.spark.sql(f"ALTER TABLE {versions} ADD COLUMNS ({', '.join(new)})")
        lacking = {f.name: F.lit(None).cast(f.dataType) for f in stored if f.name not in df.columns}
        return df.withColumns(lacking)

    def stage(
        self,
        df: DataFrame,
        table: str,
        kind: str | None = None,
        check: Callable[[], None] | None = None,
        aside: T.StructType | None = None,
    ) -> None:
        """Write a new table that nobody reads before the switch. ``kind`` tells tables of one name
        and different columns apart. With ``aside``, columns that the table doesn't have, rows with
        a value in one of them are put aside."""
        hidden = [] if aside is None else aside.names
        self.staged[table] = f"{kind or table}_versions"
        self.columns[table] = [c for c in df.columns if c not in hidden]
        versions = f"{self.database}.{self.staged[table]}"
        mark = F.lit(self.mark)
        if aside is not None:
            mark = F.when(_is_aside(aside), f"{self.mark}-{ASIDE}").otherwise(self.mark)
        marked = self._fitted(df, versions).withColumn(VERSION, mark)
        with unsorted_writes(self.spark):
            marked.write.format("parquet").mode("append").partitionBy(VERSION).saveAsTable(versions)
        if check:
            check()

    def _read(self, table: str, mark: str, schema: T.StructType) -> DataFrame:
        versions = self.spark.table(f"{self.database}.{self.staged[table]}")
        return versions.where(F.col(VERSION) == mark).select(*schema.names)

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The new table, before the switch."""
        return self._read(table, self.mark, schema)

    def read_aside(self, table: str, schema: T.StructType) -> DataFrame:
        """What the table's write put aside."""
        return self._read(table, f"{self.mark}-{ASIDE}", schema)

    def drop_aside(self, table: str) -> None:
        """Remove what the table's write put aside."""
        self._forget(self.staged[table], f"{self.mark}-{ASIDE}")

    def publish(self, table: str) -> None:
        """A table of a catalog has no plain folder."""

    def _point(self, tables: dict[str, str | None]) -> None:
        values = [f"{'NULL' if v is None else repr(v)} AS `{t}`" for t, v in sorted(tables.items())]
        columns = ", ".join(values).replace("NULL AS", "CAST(NULL AS STRING) AS")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{CATALOG_POINTER} AS SELECT {columns}")

    def switch(self) -> None:
        """Show all new tables at once. A table that is new to the database is empty until then; one
        whose columns change is empty for a moment, since its own view is replaced as well."""
        current = self._current()
        if not self.staged.keys() <= current.keys():
            current |= {table: None for table in self.staged.keys() - current.keys()}
            self._point(current)
        for table, versions in self.staged.items():
            view = f"{self.database}.{table}"
            listed = self.spark.catalog.listTables(self.database, table) if self.spark.catalog.tableExists(view) else []
            if listed and listed[0].tableType != "VIEW":
                self.spark.sql(f"ALTER TABLE {view} RENAME TO {self.database}.{table}_former")
                listed = []
            if not listed or self.spark.table(view).columns != self.columns[table]:
                columns = ", ".join(f"`{c}`" for c in self.columns[table])
                pointer = f"(SELECT `{table}` FROM {self.database}.{CATALOG_POINTER})"
                self.spark.sql(
                    f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} "
                    f"FROM {self.database}.{versions} WHERE {VERSION} = {pointer}"
                )
        self._point(current | dict.fromkeys(self.staged, self.mark))

    def give_up(self) -> None:
        """Remove what was written; the tables stay as they were."""
        for versions in set(self.staged.values()):
            if self.spark.catalog.tableExists(f"{self.database}.{versions}"):
                self._forget(versions, self.mark)
                self._forget(versions, f"{self.mark}-{ASIDE}")


Generation = PathGeneration | CatalogGeneration


@contextmanager
def generation(
    spark: SparkSession, base: str | None = None, *, database: str | None = None
) -> Iterator[Generation]:
    """Replace the tables staged inside, all or none, when the block ends without an error."""
    if database is None and base is None:
        raise ValueError("give a base path or a database")
    new = PathGeneration(spark, base) if database is None else CatalogGeneration(spark, database)
    new.tidy()
    try:
        yield new
    except BaseException:
        new.give_up()
        raise
    new.switch()
