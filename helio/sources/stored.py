"""Changes to stored Parquet tables: clustered partition writes, copy-on-write deletes by file, purges over many tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def clustered(df: DataFrame, partition: list[str]) -> DataFrame:
    """Rows of one partition value brought together by one exchange, small ones joined and large ones split by their size at run time."""
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({', '.join(f'`{c}`' for c in partition)}) */ * FROM {{df}}", df=df)


@contextmanager
def _open_files(spark: SparkSession, most: int = 16) -> Iterator[None]:
    """Partitioned writes inside keep up to ``most`` files of a task open; only what has more partition values is sorted by them in memory."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_partitioned(df: DataFrame, path: str, partition: list[str], mode: str = "append", most_rows: int = 5_000_000, dynamic: bool = False) -> None:
    """Write a table by partition values, of which each gets as few files as its size allows, whatever the number of tasks.

    Without ``partition`` columns the rows are written where they are. ``dynamic``: overwriting leaves partitions that get no rows.
    A task with a large share of one partition writes it as it comes, without holding it for a sort.
    """
    writer = (clustered(df, partition) if partition else df).write.mode(mode).option("maxRecordsPerFile", most_rows)
    writer = writer.option("partitionOverwriteMode", "dynamic") if dynamic else writer
    with _open_files(df.sparkSession):
        (writer.partitionBy(*partition) if partition else writer).parquet(path)


class Files:
    """The files of a table, in whatever store Spark reads it from."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.base = spark._jvm, path.rstrip("/")
        self.fs = self.at(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def plain(self, address: str) -> str:
        """A path as text from Spark's ``file_path``, where it is escaped as an address."""
        return self.jvm.org.apache.hadoop.fs.Path(self.jvm.java.net.URI(address)).toString()

    def data_files(self, path: str) -> list[str]:
        """Data files under a folder; those in hidden folders are none."""
        found, each = [], self.fs.listFiles(self.at(path), True)
        below = len(self.fs.makeQualified(self.at(path)).toString())
        while each.hasNext():
            name = each.next().getPath().toString()
            if not any(part[:1] in "._" for part in name[below:].strip("/").split("/")):
                found.append(name)
        return found

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.at(target).getParent())
        if self.fs.exists(self.at(source)) and not self.fs.rename(self.at(source), self.at(target)):
            raise OSError(f"{source} can't be moved to {target}")

    def remove(self, path: str) -> None:
        self.fs.delete(self.at(path), True)

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self.at(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        source = self.fs.open(self.at(path))
        try:
            return bytes(self.jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(source)).decode()
        finally:
            source.close()

    def journals(self) -> list[str]:
        if not self.fs.exists(self.at(self.base)):
            return []
        return [x.getPath().toString() for x in self.fs.listStatus(self.at(self.base)) if x.getPath().getName().startswith("_change-") and x.getPath().getName().endswith(".json")]


def _apply(files: Files, journal: str) -> int:
    """Carry out a journal's moves and removals, as far as they are not done, and remove it; the number of partitions that went."""
    plan = json.loads(files.read(journal))
    for source, target in plan["moves"]:
        files.move(source, target)
    for name in plan["removes"]:
        files.remove(name)
    gone = 0
    root = files.fs.makeQualified(files.at(files.base)).toString()
    for folder in sorted({name.rpartition("/")[0] for name in plan["removes"]}, key=len, reverse=True):
        while folder != root and files.fs.exists(files.at(folder)) and not files.data_files(folder):
            files.remove(folder)
            gone += 1
            folder = folder.rpartition("/")[0]
    files.remove(plan["staged"])
    files.remove(journal)
    return gone


def recover(spark: SparkSession, path: str) -> int:
    """Finish changes that a lost driver left half done; how many. Before its journal stands, a change has not touched the table."""
    files = Files(spark, path)
    found = files.journals()
    for journal in found:
        _apply(files, journal)
    return len(found)


def delete_stored(spark: SparkSession, path: str, condition: Column | None, partition: list[str] = ()) -> dict:  # type: ignore[assignment]
    """Delete rows of a stored table for which ``condition`` is true (all rows without one); figures of what was done.

    Only files that hold such rows are rewritten, without them; files that hold nothing else go, and so do partitions that are left
    without rows. All other files stay as they are. What replaces files is written beside the table first, then a
    journal names the moves and removals, then they are carried out; ``recover`` finishes them after a lost driver. A reader
    that lists the table while files are exchanged may see both. A table that loses all its rows keeps its schema in an
    empty file. The driver handles one line for each file that is touched.
    """
    recover(spark, path)
    table = spark.read.parquet(path)
    hit = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    per_file = table.select(hit.alias("_hit"), F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.count_if("_hit").alias("hits"))
    touched = per_file.where("hits > 0").collect()
    files, mark = Files(spark, path), uuid.uuid4().hex
    figures = {"deleted": sum(r["hits"] for r in touched), "files_rewritten": sum(r["hits"] < r["n"] for r in touched), "files_removed": sum(r["hits"] == r["n"] for r in touched), "partitions_dropped": 0}
    if not touched:
        return figures
    staged, names = f"{files.base}/_change-{mark}", [files.plain(r["_file"]) for r in touched]
    rewrite = [name for name, r in zip(names, touched, strict=True) if r["hits"] < r["n"]]
    if rewrite:
        rest = spark.read.schema(table.schema).option("basePath", path).parquet(*rewrite).where(~hit)
        write_partitioned(rest, staged, list(partition), "errorifexists")
    everything = per_file.where("hits < n").isEmpty()
    if everything and not partition:
        table.limit(0).write.mode("overwrite").parquet(staged)
    base = files.fs.makeQualified(files.at(staged)).toString()
    moves = [(x, f"{files.base}{x[len(base) :]}") for x in (files.data_files(staged) if files.fs.exists(files.at(staged)) else [])]
    if everything and partition:  # partition folders go with their rows; an empty file without them would lose their columns
        folder = "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in partition)
        table.drop(*partition).limit(0).write.mode("overwrite").parquet(staged)
        moves = [(x, f"{files.base}/{folder}/{x.rpartition('/')[2]}") for x in files.data_files(staged)]
    files.write(f"{files.base}/_change-{mark}.json", json.dumps({"staged": staged, "moves": moves, "removes": names}))
    figures["partitions_dropped"] = _apply(files, f"{files.base}/_change-{mark}.json")
    spark.catalog.refreshByPath(path)
    return figures


def drop_partitions(spark: SparkSession, path: str, values: DataFrame, partition: str) -> int:
    """Remove the partitions of ``values`` (rows with the column ``partition``) as folders; all others stay as they are. How many went."""
    first = spark.read.parquet(path).where("_metadata.row_index = 0")  # a row for each file
    stored = first.select(F.col(partition).alias("_value"), F.col("_metadata.file_path").alias("_file"))
    gone = stored.join(F.broadcast(values), F.col("_value").eqNullSafe(values[partition]), "left_semi")
    folders = [r["_folder"] for r in gone.select(F.regexp_replace("_file", "/[^/]*$", "").alias("_folder")).distinct().collect()]
    files = Files(spark, path)
    for folder in folders:
        files.remove(files.plain(folder))
    spark.catalog.refreshByPath(path)
    return len(folders)


class Bucketed:
    """A stored table whose files are bucketed on its key, as versions under a folder: an upsert moves its batch only, not the table.

    ``read`` registers the last whole version in the session's catalog, with its buckets, so that joins and aggregations
    on the key need no exchange. A write makes a new version and keeps the one before it for readers under way.
    """

    def __init__(self, spark: SparkSession, base: str, keys: list[str], buckets: int) -> None:
        self.spark, self.base, self.keys, self.buckets = spark, base.rstrip("/"), keys, buckets

    def _versions(self) -> list[int]:
        files = Files(self.spark, self.base)
        if not files.fs.exists(files.at(self.base)):
            return []
        names = [x.getPath().getName() for x in files.fs.listStatus(files.at(self.base))]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and files.fs.exists(files.at(f"{self.base}/{n}/_SUCCESS")))

    def write(self, df: DataFrame) -> None:
        files, known = Files(self.spark, self.base), self._versions()
        path, name = f"{self.base}/v{(known or [0])[-1] + 1}", f"bucketed_{uuid.uuid4().hex}"
        files.remove(path)  # what a lost driver left
        df.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", path).format("parquet").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the catalog's entry; its files stay
        for old in known[:-1]:
            files.remove(f"{self.base}/v{old}")

    def read(self) -> DataFrame | None:
        known = self._versions()
        if not known:
            return None
        path, name = f"{self.base}/v{known[-1]}", f"bucketed_{uuid.uuid4().hex}"
        columns = self.spark.read.parquet(path)._jdf.schema().toDDL()
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def merged(self, source: DataFrame) -> DataFrame:
        """The table with rows of equal keys replaced and new keys added; ``source`` has each key once, without nulls, and the table's columns."""
        target = self.read()
        if target is None:
            return source
        rows = source.select(*[F.col(c).alias(f"_s_{c}") for c in target.columns], F.lit(True).alias("_new"))
        on = [F.col(k) == F.col(f"_s_{k}") for k in self.keys]
        return target.join(rows, on, "full_outer").select(*[F.when(F.col("_new"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns])

    def upsert(self, source: DataFrame) -> None:
        self.write(self.merged(source))


#: Columns by which tables of any layer are purged, the first that a table has.
PURGE_COLUMNS = ("ingest_date", "ingest_timestamp", "weather_date", "air_date", "date", "full_date", "event_date", "event_timestamp", "created_at", "updated_at", "date_hour", "date_key")


def purge(spark: SparkSession, tables: dict[str, tuple[str, list[str]]], condition, dry_run: bool = False) -> DataFrame:
    """Delete by a date range from many stored tables, name: (path, partition columns); a row for each with its figures.

    ``condition(df)`` gives the predicate of a table or raises ValueError where the table has no date column; such a table is left
    alone (``skipped``), as all are in a dry run, which counts only.
    """
    rows = []
    for name, (path, partition) in tables.items():
        df = spark.read.parquet(path)
        try:
            hit = condition(df)
        except ValueError:
            rows.append((name, 0, 0, 0, 0, True))
            continue
        if dry_run:
            rows.append((name, df.where(hit).count(), 0, 0, 0, False))
        else:
            done = delete_stored(spark, path, hit, partition)
            rows.append((name, *done.values(), False))
    return spark.createDataFrame(rows, "table_name string, deleted long, files_rewritten long, files_removed long, partitions_dropped long, skipped boolean")
