"""File readers, and writers of what they read."""

from __future__ import annotations

import bz2
import gzip
import os
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.keep import keep_last
from ..schemas import INDUSTRY

#: Codec of stored texts and pages, the greater part of what is written for them.
TEXT_CODEC = "zstd"


def gbk_lines(files: DataFrame) -> DataFrame:
    """Rows of a binary-file source as GBK text lines (needs the charset option)."""
    text = F.regexp_replace(F.decode(F.col("content"), "GBK"), "\r\n?", "\n")
    return files.select(
        F.col("path"), F.explode(F.split(text, "\n")).alias("value")
    ).filter(F.trim("value") != "")


def read_gbk(spark: SparkSession, path: str) -> DataFrame:
    """Lines of GBK-encoded landing files."""
    return gbk_lines(spark.read.format("binaryFile").load(path))


def document_columns(name: Column, today: Column) -> tuple[Column, Column]:
    """Code and date out of a file name such as ``000001_20260622.txt``.

    A part file stands for its folder, if that is ``name=000001_20260622``.
    """
    folder = F.regexp_extract(name, "/name=([^/]+)/part-[^/]*$", 1)
    base = F.when(folder != "", folder).otherwise(F.regexp_extract(name, "([^/]+)$", 1))
    code = F.regexp_extract(base, "^([^_.]+)", 1)
    day = F.regexp_extract(base, r"(\d{8})", 1)
    return code, F.coalesce(F.try_to_date(day, "yyyyMMdd"), today)


def read_documents(spark: SparkSession, path: str, today: str | None = None) -> DataFrame:
    """Whole text files as (stock_code, trade_date, file_path, text).

    Files of a mounted folder are listed and read by the tasks, when the rows are asked for: the driver
    sees none of their names, however many there are. Hidden and empty files are left out and packed ones
    unpacked, as Spark's reader does it, which reads single files, patterns and other stores; there the
    driver holds the list of files.
    """
    day = F.current_date() if today is None else F.lit(today).cast("date")
    root = _mounted(spark, path)
    if root is not None:
        files = _mounted_files(spark, root)
    else:
        files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
        files = files.select(F.col("_metadata.file_path").alias("file_path"), "value")
    code, date = document_columns(F.col("file_path"), day)
    return files.select(
        code.alias("stock_code"),
        date.alias("trade_date"),
        "file_path",
        F.regexp_replace("value", "\r\n?", "\n").alias("text"),
    )


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The plain name of a folder that every task can open, if the path is one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file" or not fs.exists(where) or not fs.getFileStatus(where).isDirectory():
        return None
    return fs.makeQualified(where).toUri().getPath()


def _mounted_files(spark: SparkSession, root: str) -> DataFrame:
    """(file_path, value) of all files below a mounted folder.

    A task lists the folder, tasks walk through the folders in it, and pieces of the list are dealt out
    to those that read. What a task holds is a piece of the list and the texts of a batch.
    """
    # a number of parts of its own: by the size of the list they would be brought together
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (top, below, read), piece = _file_tasks(), "folder string, names array<string>"
    entries = spark.createDataFrame([(root,)], "folder string").mapInArrow(top, piece)
    pieces = entries.repartition(tasks).mapInArrow(below, piece).repartition(tasks)
    files = pieces.mapInArrow(read, "file_path string, value binary")
    return files.select("file_path", F.col("value").cast("string").alias("value"))


#: Names in a piece of a list of files, and bytes of texts in a batch of more than one.
_PIECE_NAMES, _READ_BYTES = 256, 1 << 22


def _file_tasks() -> tuple[Callable, Callable, Callable]:
    """What the tasks do that list a folder, walk through the folders in it and read files.

    The functions have all they need with them, so the workers needn't import this package.
    """
    pieces = pa.schema([("folder", pa.string()), ("names", pa.list_(pa.string()))])
    contents = pa.schema([("file_path", pa.string()), ("value", pa.binary())])
    # files that Hadoop's codecs pack; of the last two kinds it packs blocks of its own
    packed = {
        ".gz": gzip.decompress, ".bz2": bz2.decompress, ".deflate": zlib.decompress,
        ".zst": lambda found: pa.CompressedInputStream(pa.BufferReader(found), "zstd").read(),
        ".lz4": None, ".snappy": None,
    }
    # java.net.URI spells a path with these characters as they are, and of the others quotes those below
    # 128, white space and control characters
    plain, spaces = re.compile(r"[A-Za-z0-9_\-!.~'()*,;:$&+=@/]*"), re.compile("[\x80-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

    def spelled(path: str) -> str:
        if plain.fullmatch(path):
            return path
        return "".join(c if plain.fullmatch(c) or (ord(c) > 127 and not spaces.match(c)) else quote(c, safe="") for c in path)

    def hidden(name: str) -> bool:  # from Spark's readers
        return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")

    def piece(folder: str, names: list[str] | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"folder": folder, "names": names}], pieces)

    def listed(folder: str, deep: bool) -> Iterator[pa.RecordBatch]:
        folders = [folder]
        while folders:
            here, names = folders.pop(), []
            with os.scandir(here) as entries:
                for entry in entries:
                    if hidden(entry.name):
                        continue
                    if not entry.is_dir():
                        names.append(entry.name)
                    elif deep:
                        folders.append(entry.path)
                    else:
                        yield piece(entry.path, None)
                    if len(names) == _PIECE_NAMES:
                        yield piece(here, names)
                        names = []
            if names:
                yield piece(here, names)

    def content(file: str) -> bytes | None:  # Spark's readers skip empty files
        with open(file, "rb") as opened:
            found = opened.read()
        kind = os.path.splitext(file)[1]
        if not found or kind not in packed:
            return found or None
        if packed[kind] is None:
            raise ValueError(f"{file} is packed in a way that only Spark's reader unpacks: read it by its own path")
        return packed[kind](found)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                yield from listed(folder, deep=False)

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["names"] is None:
                    yield from listed(row["folder"], deep=True)
                else:
                    yield piece(row["folder"], row["names"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                for name in row["names"]:
                    file = f"{row['folder'].rstrip('/')}/{name}"
                    text = content(file)
                    if text is None:
                        continue
                    if held and size + len(text) > _READ_BYTES:
                        yield pa.RecordBatch.from_pylist(held, contents)
                        held, size = [], 0
                    held.append({"file_path": f"file:{spelled(file)}", "value": text})
                    size += len(text)
        if held:
            yield pa.RecordBatch.from_pylist(held, contents)

    return top, below, read


def write_documents(docs: DataFrame, path: str) -> None:
    """A text file per document (name, text) in a new folder, as ``read_documents`` reads them.

    Every task has a folder of its own for its files, so folders are as many as tasks. Rows of one name
    that lie in one task are lines of one file. On a mounted folder the tasks write the files
    themselves: Hadoop's local file system starts a process for each file to set its mode, and
    moves it when the job commits. Other stores get them from Spark's writer, in a folder per name.
    """
    where = urlparse(path)
    if where.scheme not in ("", "file"):
        docs.select("name", "text").write.partitionBy("name").text(path)
        return
    root = unquote(where.path) if where.scheme else path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, now, out, made = f"{root}/{TaskContext.get().partitionId():05d}", None, None, None
        for batch in batches:
            for name, text in zip(batch.column("name"), batch.column("text")):
                # a document without a name lies where Spark's writer puts it
                file = f"{name}.txt" if name.is_valid else "name=__HIVE_DEFAULT_PARTITION__/part-0.txt"
                if file != now:
                    if out is not None:
                        out.close()
                    if (place := os.path.dirname(f"{folder}/{file}")) != made:
                        os.makedirs(place, exist_ok=True)  # once, for a look at it costs more than a file
                        made = place
                    now, out = file, open(f"{folder}/{file}", "wb")
                out.write((text.as_py() or b"") + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])
        if out is not None:
            out.close()

    os.makedirs(root)
    rows = docs.select("name", F.col("text").cast("binary").alias("text")).sortWithinPartitions("name")
    rows.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def land_documents(docs: DataFrame, path: str, batch: str) -> None:
    """Append documents (stock_code, trade_date, text) to a container table, as one batch.

    One row per document, with the hash of its text: the small columns are the landing index,
    and texts are read by batch. A repeated batch replaces itself.
    """
    rows = docs.select("stock_code", "trade_date", F.substring(F.sha2("text", 256), 1, 16).alias("source_hash"), "text")
    rows.withColumn("batch", F.lit(batch)).sortWithinPartitions("stock_code").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).option("compression", TEXT_CODEC).partitionBy("batch").parquet(path)


def landed_documents(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """(stock_code, trade_date, text) of the newest landed document of each code.

    With ``known`` (stock_code, source_hash), only documents whose text is another. They are
    found in the index alone; then only the batches that hold them are scanned for texts.
    """
    landed = spark.read.option("basePath", path).parquet(path).withColumn("batch", F.col("batch").cast("string"))
    place = F.struct("trade_date", "batch", "source_hash")
    newest = landed.groupBy("stock_code").agg(F.max(place).alias("n")).select("stock_code", "n.*")
    if known is not None:
        same = known.select("stock_code", "source_hash").distinct()
        newest = newest.join(same, ["stock_code", "source_hash"], "left_anti")
    batches = [r[0] for r in newest.select("batch").distinct().collect()]  # one name per landing
    texts = landed.filter(F.col("batch").isin(batches))
    keys = ["stock_code", "trade_date", "batch", "source_hash"]
    # rows of one key have one text: they are dropped where the join has put them, texts don't move again
    return texts.join(newest, keys, "left_semi").dropDuplicates(keys).select("stock_code", "trade_date", "text")


def compact_documents(spark: SparkSession, path: str, file_rows: int = 10_000) -> int:
    """Merge the landed batches into one container, sorted by code; returns the documents kept.

    Many small landings become files of up to ``file_rows`` documents, each a range of codes, so
    the index is read from few footers and a code's texts from few row groups. Of a code and date only
    the document that landed last is kept; no other could be the newest. The container's name sorts right after
    the last batch it holds, and batches go once it is complete: what is the newest never changes, also if
    the job stops in between.
    """
    landed = spark.read.option("basePath", path).parquet(path).withColumn("batch", F.col("batch").cast("string"))
    batches = [r[0] for r in landed.select("batch").distinct().collect()]  # one name per landing
    if len(batches) < 2:
        return landed.count()
    name = max(batches) + "!"
    kept, seen = keep_last(landed, ["stock_code", "trade_date"], ["batch", "source_hash"]).drop("batch"), Observation()
    ranged = kept.repartitionByRange("stock_code", "trade_date").sortWithinPartitions("stock_code", "trade_date")
    beside = f"{path}/batch={name}"
    ranged.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).option("maxRecordsPerFile", file_rows).option("compression", TEXT_CODEC).parquet(beside)
    for batch in batches:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={batch}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return seen.get["n"]


def read_industry(spark: SparkSession, path: str) -> DataFrame:
    """Industry CSV, all text; rows without code or industry are dropped."""
    return spark.read.csv(path, header=True, schema=INDUSTRY).filter(
        (F.col("code") != "") & (F.col("industry") != "")
    )
