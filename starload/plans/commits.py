"""Stored tables that change together.

A batch never touches a file that a reader may have open: it writes new folders (``c=<number>`` under the table, for a
partitioned table under each partition that it touches), and then one commit names, for every table and partition, the folder
that holds it.  A commit counts from the moment its marker exists, so all tables of a batch appear at once, and a batch that is
killed between two tables leaves the state before it.  A commit with a number that exists already is not made again, which makes
a replayed batch or micro-batch harmless.  There is one writer at a time.

A commit has one row a partition (one a day for the facts), which bounds what the driver reads; tables are read and written by
Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.schemas import empty_frame

COMMIT = T.StructType([T.StructField(n, T.StringType()) for n in ("table", "part", "path")])
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Names and paths of the folders in ``path``."""
    fs, p = _fs(spark, path)
    return {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()} if fs.exists(p) else {}


def _done(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, f"{path}/_SUCCESS")
    return bool(fs.exists(p))


def commits(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the commits made, in order."""
    found = _folders(spark, f"{root}/_commits")
    return sorted(int(n[2:]) for n, p in found.items() if n.startswith("c=") and n[2:].isdigit() and _done(spark, p))


@dataclass
class State:
    """What a commit names: (table, partition or None) -> folder under the root."""

    root: str
    number: int = -1
    paths: dict = field(default_factory=dict)

    def next(self, number: int | None = None) -> State:
        """A state to change, which becomes a commit of its own."""
        return State(self.root, self.number + 1 if number is None else number, dict(self.paths))

    def folders(self, table: str) -> list[str]:
        return sorted(f"{self.root}/{p}" for (t, _), p in self.paths.items() if t == table)

    def parts(self, table: str) -> list[str]:
        return sorted(part for t, part in self.paths if t == table and part is not None)


def state(spark: SparkSession, root: str, number: int | None = None) -> State:
    """The last commit, or the one with ``number``; before the first there is nothing."""
    root = root.rstrip("/")
    if number is None:
        made = commits(spark, root)
        if not made:
            return State(root)
        number = made[-1]
    rows = spark.read.schema(COMMIT).json(f"{root}/_commits/c={number}").collect()
    return State(root, number, {(r["table"], r["part"]): r["path"] for r in rows})


def read_table(spark: SparkSession, at: State, table: str, schema: T.StructType) -> DataFrame:
    """A table as ``at`` names it.  Partitions are found by their folders, so a filter on the partition column prunes them."""
    folders = at.folders(table)
    if not folders:
        return empty_frame(spark, schema)
    return spark.read.schema(schema).option("basePath", f"{at.root}/{table}").parquet(*folders).select(*schema.names)


def put_table(at: State, table: str, rows: DataFrame) -> None:
    """Make ``table`` hold ``rows``."""
    path = f"{table}/c={at.number}"
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{at.root}/{path}")
    at.paths[(table, None)] = path


def put_partitions(at: State, table: str, rows: DataFrame, part: str, parts: list) -> None:
    """Make the partitions ``parts`` of ``table`` hold exactly ``rows``; one that gets no rows is gone, the others stay."""
    spark, base = rows.sparkSession, f"{at.root}/{table}"
    (rows.withColumn("c", F.lit(at.number)).write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd")
     .partitionBy(part, "c").parquet(base))
    for value in parts:
        name = NULL_PART if value is None else str(value)
        path = f"{table}/{part}={name}/c={at.number}"
        fs, p = _fs(spark, f"{at.root}/{path}")
        if fs.exists(p):
            at.paths[(table, name)] = path
        else:
            at.paths.pop((table, name), None)


def commit(spark: SparkSession, at: State) -> State:
    """Publish everything that was put into ``at``."""
    if at.number not in commits(spark, at.root):
        rows = [(t, part, path) for (t, part), path in sorted(at.paths.items(), key=str)]
        spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("overwrite").json(f"{at.root}/_commits/c={at.number}")
    return at


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the folders that none of the last ``keep`` commits names, and older commits; the number of deleted folders.
    Readers of older commits must be done."""
    root = root.rstrip("/")
    made = commits(spark, root)
    named, gone = set(), 0
    for number in made[-keep:]:
        named |= set(state(spark, root, number).paths.values())

    def drop(path: str) -> None:
        fs, p = _fs(spark, path)
        fs.delete(p, True)

    last = made[-1] if made else -1
    for table in _folders(spark, root):
        for name in [] if table.startswith("_") else _folders(spark, f"{root}/{table}"):
            inner = [f"{table}/{name}"] if name.startswith("c=") else [f"{table}/{name}/{n}" for n in _folders(spark, f"{root}/{table}/{name}")]
            for path in inner:
                if path not in named and int(path.rsplit("c=", 1)[1]) <= last:
                    drop(f"{root}/{path}")
                    gone += 1
    for number in made[:-keep]:
        drop(f"{root}/_commits/c={number}")
    return gone


def publish(spark: SparkSession, at: State, database: str, tables: dict) -> None:
    """Let the catalog tables of ``database`` show what ``at`` names: each table, or each partition, gets its folder as location.
    Only locations that differ are changed.  ``tables`` maps names to (schema, partition column)."""
    for table, (_, part) in tables.items():
        name = f"{database}.{table}"
        if part is None:
            for path in at.folders(table):
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            continue
        now = {p.removeprefix(f"{part}="): p for p in (r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())}
        values = {p: ("NULL" if p == NULL_PART else p) for p in {*at.parts(table), *now}}
        for p in at.parts(table):
            verb = "PARTITION ({}) SET LOCATION '{}'" if p in now else "ADD PARTITION ({}) LOCATION '{}'"
            spark.sql(f"ALTER TABLE {name} " + verb.format(f"{part}={values[p]}", f"{at.root}/{at.paths[(table, p)]}"))
        for p in set(now) - set(at.parts(table)):
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({part}={values[p]})")
    for table in tables:
        spark.catalog.refreshTable(f"{database}.{table}")
