"""Table access and the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table; zone-less timestamps become UTC timestamps, so that they can carry watermarks."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*(F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files are too few for that (less than a full split per core): for
    costly expressions over small tables.  Larger inputs stay as they are read, without a shuffle."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * (128 << 20) else df


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # A pattern, as a file source takes folders or patterns but no single file.
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")
    return df.select(*(F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes))


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only in local mode where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tagframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tagframe-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
