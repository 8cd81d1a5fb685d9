"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words everywhere in this subpackage.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words as long; null text has none. Runs of non-space collapse to one mark each, which are counted."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SPACE}]+", "x")
    return F.length(F.translate(marks, "\t\n\x0b\f\r ", "")).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints that the session names. Only where driver and executors are one process, one of our own can stand in."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="postmill-"))
    return named or context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """Write a frame to the checkpoint folder now and go on from there: what follows neither recomputes it nor depends on executors."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def cut_table(frame: DataFrame) -> DataFrame:
    """As cut, but as a Parquet table, which is smaller and lets readers take single columns."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop_table(frame: DataFrame) -> None:
    """Delete what cut_table wrote, once nothing that is still to come reads it."""
    spark = frame.sparkSession
    for path in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
