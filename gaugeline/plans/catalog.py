"""Partitions and locations of catalog tables.

Tables are plain Parquet in the catalog. New data is always written to a folder of its own
first; tables change only by catalog statements that follow a finished write, so a job that
dies half-way leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import lake_location, unique

Spec = dict[str, str]

_PENDING = "pending_swap"
_CHUNK = 200


def _literal(spec: Spec) -> str:
    return ", ".join(f"{name}='{value}'" for name, value in spec.items())


def partitions(spark: SparkSession, table: str, **fixed: str) -> list[Spec]:
    """Partition values from the catalog alone, optionally those with some values fixed."""
    only = f" PARTITION ({_literal(fixed)})" if fixed else ""
    rows = spark.sql(f"SHOW PARTITIONS {table}{only}").collect()
    return [
        {k: unquote(v) for k, v in (part.split("=", 1) for part in row[0].split("/"))}
        for row in rows
    ]


def drop_partitions(spark: SparkSession, table: str, specs: Sequence[Spec]) -> None:
    """Drop partitions by full value; the files of a managed table go with them."""
    for i in range(0, len(specs), _CHUNK):
        listed = ", ".join(f"PARTITION ({_literal(s)})" for s in specs[i : i + _CHUNK])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")


def path_of(root: str, spec: Spec) -> str:
    return "/".join([root, *[f"{name}={value}" for name, value in spec.items()]])


def add_partitions(spark: SparkSession, table: str, specs: Sequence[Spec], root: str) -> None:
    for i in range(0, len(specs), _CHUNK):
        listed = " ".join(
            f"PARTITION ({_literal(s)}) LOCATION '{path_of(root, s)}'" for s in specs[i : i + _CHUNK]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {listed}")


def move_partitions(spark: SparkSession, table: str, specs: Sequence[Spec], root: str) -> None:
    """Let partitions that are there point to their folders below ``root``."""
    for s in specs:
        spark.sql(f"ALTER TABLE {table} PARTITION ({_literal(s)}) SET LOCATION '{path_of(root, s)}'")


@dataclass(frozen=True)
class Layout:
    """How rows are placed in the files of a table.

    ``gather`` names columns whose equal values go to the same files. An empty ``gather`` writes
    rows from where they are, without a shuffle. ``sort`` orders rows inside a file.
    """

    gather: dict[str, Column] = field(default_factory=dict)
    sort: Sequence[str] = ()


def write(df: DataFrame, table: str, layout: Layout, overwrite: bool = False) -> None:
    """Insert ``df`` into ``table``.

    Gathering is a rebalance: it splits what is large and merges what is small, so that neither
    a hot device nor a hot day ends up in one task, and small loads do not leave many files.
    """
    columns = df.sparkSession.table(table).columns
    placed = df
    if layout.gather:
        helpers = {f"_by{i}": c for i, c in enumerate(layout.gather.values())}
        placed = df.withColumns(helpers).hint("rebalance", *helpers)
    placed = placed.select(*columns)
    if layout.sort:
        placed = placed.sortWithinPartitions(*layout.sort)
    placed.write.mode("overwrite" if overwrite else "append").insertInto(table)


def stage(
    spark: SparkSession, table: str, df: DataFrame, layout: Layout
) -> tuple[str, list[Spec]]:
    """Write ``df`` with the layout of ``table`` to a new folder; its path and partitions."""
    twin = f"{table}_{unique('s')}"
    root = f"{lake_location(spark, table)}/_staged/{twin.split('.')[-1]}"
    spark.sql(f"CREATE TABLE {twin} LIKE {table} USING parquet LOCATION '{root}'")
    try:
        write(df, twin, layout)
        specs = partitions(spark, twin) if partition_columns(spark, twin) else []
    finally:
        spark.sql(f"DROP TABLE {twin}")  # external: its files stay
    return root, specs


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def load_label(
    spark: SparkSession, table: str, df: DataFrame, label: str, layout: Layout, check: Callable[[], None] | None = None
) -> None:
    """Idempotent load, all of it or nothing: what an earlier attempt wrote under ``label`` is
    replaced, and stays if this attempt fails.

    Without an earlier attempt the rows are written in place: the partitions enter the catalog
    together, after the files. The overwrite is dynamic (a table option), so it also clears files
    that a dead attempt left without a catalog entry. Otherwise they are written beside the table,
    and the label's partitions then point to them.

    ``check`` runs once the rows are written beside the table, and before readers see any; if it raises,
    they are removed and the table is as it was. It can look at what the write itself has observed.
    """
    finish_swap(spark, table)
    rows = df.withColumn("load_label", F.lit(label))
    held = partitions(spark, table, load_label=label)
    if not held and check is None:
        write(rows, table, layout, overwrite=True)
        return
    before = [partition_location(spark, table, spec) for spec in held]
    root, new = stage(spark, table, rows, layout)
    if check is not None:
        try:
            check()
        except BaseException:
            remove_folder(spark, root)
            raise
    if not held:
        add_partitions(spark, table, new, root)
        spark.catalog.refreshTable(table)
        return
    steps = [("drop", s) for s in held if s not in new]
    steps += [("move" if s in held else "add", s) for s in new]
    _noted_swap(spark, table, root, steps)
    # No reader needs the files of an attempt that was never finished.
    for path in before:
        remove_folder(spark, path)


def swap_partition(
    spark: SparkSession, table: str, df: DataFrame, spec: Spec, layout: Layout
) -> str | None:
    """Replace one partition by one catalog statement: readers see it whole, old or new.

    The old folder is left for readers under way and returned, to be removed when they are done.
    """
    finish_swap(spark, table)
    held = bool(partitions(spark, table, **spec))
    old = partition_location(spark, table, spec) if held else None
    root, new = stage(spark, table, df, layout)
    if new and new != [spec]:
        raise ValueError(f"rows for {new} where only {spec} may be written")
    if not new:
        drop_partitions(spark, table, [spec])
        old = None
    elif held:
        spark.sql(f"ALTER TABLE {table} PARTITION ({_literal(spec)}) SET LOCATION '{path_of(root, spec)}'")
    else:
        add_partitions(spark, table, [spec], root)
    spark.catalog.refreshTable(table)
    return old


def partition_location(spark: SparkSession, table: str, spec: Spec) -> str:
    told = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({_literal(spec)})")
    return told.filter(F.col("col_name") == "Location").first()["data_type"]


def replace_partitions(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    old: Iterable[Spec],
    layout: Layout,
) -> list[Spec]:
    """Write ``df`` beside the table, then put its partitions in the place of ``old``.

    ``df`` may read the table itself. Its partitions must be new ones. What is to be dropped and
    added is noted in the table's properties first: if the driver dies between the two, the next
    change of the table finishes the swap.
    """
    finish_swap(spark, table)
    root, new = stage(spark, table, df, layout)
    _noted_swap(spark, table, root, [("drop", s) for s in old] + [("add", s) for s in new])
    return new


def _noted_swap(spark: SparkSession, table: str, root: str, steps: list[tuple[str, Spec]]) -> None:
    """Note what is to be changed, then change it. Each step can be done again."""
    if not steps:
        return
    names = partition_columns(spark, table)
    schema = ", ".join(f"`{n}` string" for n in ["step", *names])
    rows = [(step, *[spec[n] for n in names]) for step, spec in steps]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").json(f"{root}/_swap")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PENDING}'='{root}')")
    _swap(spark, table, root, steps)


def finish_swap(spark: SparkSession, table: str) -> None:
    """Complete a swap that a dead driver left behind; does nothing otherwise."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == _PENDING).collect()
    if rows:
        root = rows[0]["value"]
        names = partition_columns(spark, table)
        schema = ", ".join(f"`{n}` string" for n in ["step", *names])
        rows_ = spark.read.schema(schema).json(f"{root}/_swap").collect()
        _swap(spark, table, root, [(step, dict(zip(names, values))) for step, *values in map(tuple, rows_)])


def _swap(spark: SparkSession, table: str, root: str, steps: list[tuple[str, Spec]]) -> None:
    drop_partitions(spark, table, [s for step, s in steps if step == "drop"])
    move_partitions(spark, table, [s for step, s in steps if step == "move"], root)
    add_partitions(spark, table, [s for step, s in steps if step == "add"], root)
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{_PENDING}')")
    spark.catalog.refreshTable(table)


def publish_snapshot(
    spark: SparkSession, table: str, df: DataFrame, layout: Layout
) -> str:
    """Replace the whole content of an unpartitioned table by one catalog statement.

    Readers see the old rows or the new ones. The old folder is left for readers under way; its
    path is returned, to be removed when they are done.
    """
    old = table_location(spark, table)
    root, _ = stage(spark, table, df, layout)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{root}'")
    spark.catalog.refreshTable(table)
    return old


def table_location(spark: SparkSession, table: str) -> str:
    told = spark.sql(f"DESCRIBE FORMATTED {table}")
    return told.filter(F.col("col_name") == "Location").first()["data_type"]


def bucket_count(spark: SparkSession, table: str) -> int:
    """Buckets of a table, 0 where it has none."""
    told = spark.sql(f"DESCRIBE FORMATTED {table}").filter(F.col("col_name") == "Num Buckets").first()
    return int(told["data_type"]) if told else 0


def bucket_clause(key: str, sort_by: Sequence[str], buckets: int) -> str:
    if not buckets:
        return ""
    return f"CLUSTERED BY ({key}) SORTED BY ({', '.join(sort_by)}) INTO {buckets} BUCKETS"


def bucket_of(key: str, buckets: int) -> dict[str, Column]:
    """The bucket a row will be written to, as a clustering column."""
    return {"bucket": F.pmod(F.hash(key), F.lit(buckets))} if buckets else {}


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that no table refers to any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _folders_in_use(spark: SparkSession, database: str) -> set[str]:
    """Folders that tables and partitions of the database point to."""
    used = set()
    sessions = spark._jsparkSession.sessionState().catalog()
    for found in spark.catalog.listTables(database):
        if found.isTemporary:
            continue
        name = sessions.qualifyIdentifier(spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(f"{database}.{found.name}"))
        used.add(table_location(spark, f"{database}.{found.name}"))
        if partition_columns(spark, f"{database}.{found.name}"):
            parts = sessions.listPartitions(name, spark._jvm.scala.Option.empty()).iterator()
            while parts.hasNext():
                used.add(parts.next().location().toString())
    return used


def clean_staged(spark: SparkSession, database: str, older_than: timedelta) -> list[str]:
    """Remove what jobs that died, or versions since replaced, left beside the tables; returns it.

    Only folders are removed that no table points to and whose last change is longer ago than
    ``older_than``, which must exceed the longest job and the longest reader. A swap that a dead
    driver noted is finished first.
    """
    for found in spark.catalog.listTables(database):
        if not found.isTemporary:
            finish_swap(spark, f"{database}.{found.name}")
    used = {path.split("/_staged/")[1].split("/")[0] for path in _folders_in_use(spark, database) if "/_staged/" in path}
    root = f"{lake_location(spark, f'{database}.any')}/_staged"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(root)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    limit = jvm.java.lang.System.currentTimeMillis() - int(older_than.total_seconds() * 1000)
    gone = []
    for status in files.listStatus(target):
        if status.getPath().getName() not in used and status.getModificationTime() < limit:
            files.delete(status.getPath(), True)
            gone.append(status.getPath().getName())
    return sorted(gone)
