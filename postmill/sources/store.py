"""Reading and writing of months: JSON envelopes, partitioned tables, upserts, and what is missing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The scratch folder of an application.
_SCRATCH: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, for what later steps and the result read; it goes when the driver's process ends."""
    context = spark.sparkContext
    if context.applicationId not in _SCRATCH:
        top = f"{shared_folder(spark)}/postmill-{context.applicationId}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(top)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _SCRATCH[context.applicationId] = top
    return f"{_SCRATCH[context.applicationId]}/{name}-{uuid.uuid4().hex}"


POST_SCHEMA = "id string, author string, body string, created_utc string, thread_id string, thread_title string, url string"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints. Only where driver and executors are one process, one of our own can stand in."""
    named, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if context.getCheckpointDir() is None:
        if not named and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="postmill-"))
    return named or context.getCheckpointDir()


def read_month_json(spark: SparkSession, path: str, record: str = POST_SCHEMA) -> DataFrame:
    """Rows of JSON files with an envelope {"meta": ..., "data": [...]}, with the month of the file name. A missing path is an error."""
    schema = StructType.fromDDL(f"meta map<string, string>, data array<struct<{', '.join(f.replace(' ', ': ', 1) for f in record.split(', '))}>>")
    files = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    month = F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2})\.json", 1)
    return files.select(month.alias("month"), F.explode("data").alias("d")).select("month", "d.*")


def write_month_json(frame: DataFrame, path: str, month: str = "month") -> None:
    """JSON files, one row a line, in a folder for each month; only months that the frame has are replaced."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).json(path)


def read_month_rows(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Rows of such folders with their month. A missing path is an error."""
    return spark.read.schema(f"{record}, month string").json(path)


def read_year(spark: SparkSession, path: str, year: int, record: str) -> tuple[DataFrame, DataFrame]:
    """A year of such folders: the rows of its whole months, and of each of the twelve months (month, status, rows, broken_files).

    A month is `included`, `missing` without a folder, or `corrupt` where a file holds what is no record; a corrupt month
    gives no rows, and the others are read all the same. broken_files names those files, and rows counts what could be read.
    """
    schema = f"{record}, _corrupt_record string, month string"
    lines = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path).where(F.col("month").startswith(f"{year}-"))
    names = [f.name for f in StructType.fromDDL(record)]
    marked = lines.select("month", *names, F.when(F.col("_corrupt_record").isNotNull(), F.col("_metadata.file_name")).alias("_broken"))
    # a month has a handful of files
    seen = marked.groupBy("month").agg(F.count_if(F.col("_broken").isNull() & F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()).alias("rows"), F.sort_array(F.collect_set("_broken")).alias("broken_files"))
    months = spark.range(1, 13).select(F.format_string("%d-%02d", F.lit(year), "id").alias("month"))
    status = F.when(F.col("rows").isNull(), "missing").when(F.size("broken_files") > 0, "corrupt").otherwise("included")
    report = months.join(seen, "month", "left").select("month", status.alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("broken_files", F.array().cast("array<string>")).alias("broken_files"))
    return marked.drop("_broken").join(report.where("status = 'included'").select("month"), "month", "left_semi"), report


def write_months(frame: DataFrame, path: str, month: str = "month") -> None:
    """Replace only those months of a table that the frame has."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)


def read_months(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Months of a partitioned table; only their folders are read."""
    return spark.read.parquet(path).where(F.col("month").cast("string").between(first, last))


def upsert(existing: DataFrame, new: DataFrame, key: str, stamp: str, within: str | None = None) -> DataFrame:
    """Union by key where the strictly newer row wins, the existing one among equals.

    within: a column that follows from the key. The result is then in ranges of it, each in its order, by the same shuffle.
    """
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    both = both.repartitionByRange(within) if within else both
    order = Window.partitionBy(*filter(None, (within, key))).orderBy(F.desc(stamp), "_new")
    return both.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_new")


def unseen(found: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What has been found and is not there yet, or not with the same counts."""
    return found.join(existing.select(*keys), list(keys), "left_anti")


def with_thread_overrides(threads: DataFrame, exclude: DataFrame, include: DataFrame, key: str) -> DataFrame:
    """Threads without the excluded ones, with the included ones, each once."""
    return threads.join(exclude.select(key), key, "left_anti").unionByName(include).dropDuplicates([key])


def missing_by(rows: DataFrame, keys: Sequence[str], day: Column, unit: str) -> DataFrame:
    """Per group the days or months, by `unit`, between its first and last one that have no row, as dates in column missing.

    A group gathers each of its days once, so what it holds is bounded by the calendar.
    """
    periods = rows.select(*keys, F.date_trunc(unit, day).cast("date").alias("_at")).where("_at IS NOT NULL").distinct()
    seen = periods.groupBy(*keys).agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.collect_set("_at").alias("_have"))
    every = F.sequence("_first", "_last", F.expr(f"interval 1 {unit}"))
    return seen.select(*keys, F.explode(F.array_except(every, "_have")).alias("missing"))


def missing_months(rows: DataFrame, month: str = "month") -> DataFrame:
    """Months between the first and the last without any row."""
    from postmill.functions.dates import month_list

    months = rows.select(month).distinct()
    every = months.agg(F.min(month).alias("a"), F.max(month).alias("b")).select(F.explode(month_list(F.col("a"), F.col("b"))).alias(month))
    return every.join(months, month, "left_anti")
