"""Table writers.

Landed tables are appended to. Cleaned ones get a new version beside the old one, which
readers pick up once its success marker exists, so a job that dies half-way leaves the
previous version in place. A version is complete, or it holds only the partitions that
changed and goes on using those of older versions (``write_parts``): the list of them is
stored before the marker. So an append, a repair or a late day shows as a whole or not at
all, and no store needs to rename or overwrite anything.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Iterator, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.upsert import new_rows
from ..session import work_dir

def add_lineage(
    df: DataFrame, source: str, data_type: str, batch_id: str, ingested_at: Column | None = None
) -> DataFrame:
    return df.withColumns({
        "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        "source_system": F.lit(source),
        "source_api": F.lit(data_type),
        "batch_id": F.lit(batch_id),
    })


def append_bronze(
    df: DataFrame,
    path: str,
    source: str,
    data_type: str,
    batch_id: str,
    ingested_at: Column | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Stamp the four lineage columns and append."""
    add_lineage(df, source, data_type, batch_id, ingested_at).write.mode("append").partitionBy(
        *partition_by
    ).parquet(path)


def touched_partitions(
    stored: DataFrame, rows: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """The part of a stored table that lies in the partitions of the incoming rows.

    The distinct partition values (a handful per batch) become literals, so the scan
    prunes by them; a join condition alone would read every partition.
    """
    if not partition_by:
        return stored
    anywhere = F.lit(False)
    for values in rows.select(*partition_by).distinct().collect():
        same = F.lit(True)
        for name in partition_by:
            same = same & F.col(name).eqNullSafe(F.lit(values[name]))
        anywhere = anywhere | same
    return stored.filter(anywhere)


def measured(observation: Observation, *names: str) -> dict[str, int]:
    """Metrics of a finished write.

    Where Spark proves while running that nothing is left to write, it drops the rest of the
    plan, the observation with it; then there is no row to convert, and all metrics are 0.
    """
    try:
        return observation.get
    except Py4JJavaError as error:
        if "assertion failed" not in str(error.java_exception):
            raise
        return dict.fromkeys(names, 0)


def insert_new(
    df: DataFrame, path: str, pk: Sequence[str], partition_by: Sequence[str] = ()
) -> int:
    """Append the rows whose key is not stored yet, once per key; returns their number.

    Partition columns must be a function of the key.
    """
    spark = df.sparkSession
    held = work_dir(spark, "insert")  # the batch is looked at twice and must not change
    df.write.parquet(held)
    batch = spark.read.schema(df.schema).parquet(held)
    target = touched_partitions(read_table(spark, path, df.schema), batch, partition_by)
    counted = Observation()
    rows = new_rows(target, batch, pk).observe(counted, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)
    added = measured(counted, "n")["n"]
    remove_path(spark, held)
    return added


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def stored_years(spark: SparkSession, path: str) -> list[int]:
    """Years of a year-partitioned folder, from its listing alone."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    return sorted(int(n[5:]) for n in names if n.startswith("year=") and n[5:].isdigit())


def remove_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or an empty frame of the schema where nothing was written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def finished_versions(spark: SparkSession, root: str, below: int | None = None) -> Iterator[str]:
    """Folders of the finished versions under ``root``, newest first; markers are looked up as they are asked for."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    for name in sorted((n for n in names if n.startswith("v=")), reverse=True):
        path = spark._jvm.org.apache.hadoop.fs.Path(where, name)
        if (below is None or int(name[2:]) < below) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            yield f"{root}/{name}"


def current_version(spark: SparkSession, root: str, below: int | None = None) -> str | None:
    """Folder of the newest finished version under ``root``, or of the newest below one."""
    return next(finished_versions(spark, root, below), None)


def write_version(
    df: DataFrame, root: str, version: int | None = None, partition_by: Sequence[str] = ()
) -> str:
    """Write a complete new version; naming the version makes a repeat idempotent."""
    stamp = time.time_ns() if version is None else version
    path = f"{root}/v={stamp:020d}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)
    return path


def next_versions(spark: SparkSession, root: str, checkpoint: str) -> int:
    """Number of a stream's first version under ``root``: above all that were there when it began.

    Kept in the stream's checkpoint, so a repeated batch gets its number again, and a stream
    with a new checkpoint never hides its results behind older ones.
    """
    kept = f"{checkpoint}/first-version"
    if not path_exists(spark, kept):
        last = current_version(spark, root)
        first = 0 if last is None else int(last.rsplit("v=", 1)[1]) + 1
        write = spark.createDataFrame([(first,)], "first bigint").coalesce(1).write
        write.mode("overwrite").parquet(kept)
    return spark.read.parquet(kept).first()["first"]


def read_version(spark: SparkSession, root: str, schema: StructType, below: int | None = None) -> DataFrame:
    """The newest version, or the newest below one, with its partition column if it has one."""
    path = current_version(spark, root, below)
    if path is None:
        return spark.createDataFrame([], schema)
    folders = []
    if path_exists(spark, _kept(root, path)):
        folders = [f"{root}/{version}/{part}" for part, version in table_parts(spark, root, path)]
    if folders:
        table = spark.read.schema(schema).option("basePath", root).parquet(*folders).drop("v")
    else:
        table = spark.read.schema(schema).parquet(path)
    names = schema.fieldNames()  # a partition column of the schema has its place there, another is the last
    return table.select(*names, *[c for c in table.columns if c not in names])


def new_version(root: str) -> str:
    """Folder of a version to be written."""
    return f"{root}/v={time.time_ns():020d}"


def _kept(root: str, path: str) -> str:
    """Where a version lists the partitions of older versions that it goes on using."""
    return f"{root}/kept/{path.rsplit('/', 1)[1]}"


def table_parts(spark: SparkSession, root: str, path: str | None = None) -> list[tuple[str, str]]:
    """(partition folder, version) of all partitions that make up a version, the newest by default.

    One small row per partition and write: a full build brings them together again.
    """
    path = current_version(spark, root) if path is None else path
    if path is None:
        return []
    own, kept = [(part, path.rsplit("/", 1)[1]) for part in _partitions(spark, path)], []
    if path_exists(spark, _kept(root, path)):
        kept = [tuple(r) for r in spark.read.schema("part string, version string").parquet(_kept(root, path)).collect()]
    return sorted(own + kept)


def _partitions(spark: SparkSession, path: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return [name for name in (status.getPath().getName() for status in listed) if "=" in name]


def write_parts(
    df: DataFrame, root: str, by: str, order: Sequence[str] = (), replaced: Sequence | None = None,
    path: str | None = None, below: int | None = None, codec: str | None = None, spread: bool = True,
) -> str:
    """A new version that holds the rows of ``df``, partitioned by a column, and what it keeps.

    Partitions of the version before stay in use, but for those whose value is ``replaced``
    (an empty list replaces none, so rows are added). With None nothing is kept. ``df`` may
    read the version before: nothing of it is touched. A version that is named (``path``,
    after those ``below`` it) is made anew if it is made again. Rows that a shuffle has just dealt
    out needn't be ``spread`` once more.
    """
    spark = df.sparkSession
    if path is None:
        path = new_version(root)
    elif below is not None:
        for attempt in (path, _kept(root, path)):  # before this one
            remove_path(spark, attempt)
    if replaced is not None:
        gone, before = {f"{by}={value}" for value in replaced}, current_version(spark, root, below)
        kept = [p for p in table_parts(spark, root, before) if p[0] not in gone]
        rows = spark.createDataFrame(kept, "part string, version string").coalesce(1)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_kept(root, path))
    laid_out = df.hint("rebalance", by) if spread else df
    laid_out = laid_out.sortWithinPartitions(by, *order)
    laid_out.write.mode("append").partitionBy(by).parquet(path, compression=codec)
    return path


def drop_unused_parts(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete partitions that none of the newest ``keep`` versions uses; returns what was deleted.

    Called after every write, it has to look at the version that has just fallen out, and at
    versions of which nothing is used any more. Call it when no job reads an older version.
    """
    versions = list(itertools.islice(finished_versions(spark, root), keep + 1))
    used = {p for path in versions[:keep] for p in table_parts(spark, root, path)}
    if len(versions) <= keep:
        return []
    fallen = versions[keep]
    unused = [p for p in table_parts(spark, root, fallen) if p not in used]
    dropped = [f"{root}/{version}/{part}" for part, version in unused]
    for folder in dropped:
        remove_path(spark, folder)
    in_use = {version for _, version in used}
    for version in {version for _, version in unused} | {fallen.rsplit("/", 1)[1]}:
        if version not in in_use:
            remove_path(spark, f"{root}/{version}")
            remove_path(spark, _kept(root, f"{root}/{version}"))
            dropped.append(f"{root}/{version}")
    return dropped


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest finished versions; returns what was deleted.

    Call it when no job reads an older version any more.
    """
    newest, kept = None, []
    while len(kept) < keep:
        found = current_version(spark, root, newest)
        if found is None:
            break
        kept.append(found)
        newest = int(found.rsplit("v=", 1)[1])
    dropped = []
    while kept and (old := current_version(spark, root, newest)) is not None:
        remove_path(spark, old)
        dropped.append(old)
    return dropped


def overwrite_snapshot(df: DataFrame, root: str) -> str:
    """Replace a whole list (instruments, blocks) by its newest download."""
    return write_version(df, root)


def with_year(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("year", F.year(ts))


def by_year(df: DataFrame, *order: str) -> DataFrame:
    """Rows laid out for a year-partitioned write, sorted for row-group skipping.

    A plain exchange on the year would give each year to one task. The rebalance hint
    lets AQE cut large years into tasks of the advisory size and merge small ones, with
    no sampling pass over the input.
    """
    return df.hint("rebalance", "year").sortWithinPartitions("year", *order)


def write_by_year(
    df: DataFrame, path: str, ts: str, mode: str = "append", order: Sequence[str] = ()
) -> None:
    """Route rows to year partitions; with mode 'overwrite' only touched years change."""
    by_year(with_year(df, ts), *order, ts).write.mode(mode).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("year").parquet(path)


def write_by_freq(
    df: DataFrame, path: str, freq: str, adj: str, mode: str = "append"
) -> None:
    """Bars of one frequency and adjustment kind, as partitions of one table."""
    df.withColumns({"freq": F.lit(freq), "adj": F.lit(adj)}).write.mode(mode).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("freq", "adj").parquet(path)


def years_present(df: DataFrame) -> DataFrame:
    """Years a table holds; a partition column, so only file listings are read."""
    return df.select("year").distinct()
