"""Table reads on Parquet, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

class TableNotFound(FileNotFoundError):
    pass


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that serves
    it (local, HDFS, object stores): a read of a missing path would fail
    inside Spark and be logged by its listeners."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder this library made."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str = "parquet", int_partitions=(), merge_schema: bool = False,
               where: Column | None = None) -> DataFrame:
    """Read a table, or its rows ``where`` (which may use partition columns
    outside the schema); a missing path raises ``TableNotFound`` (not an
    analysis error deep in a plan).  Partition columns come back as int:
    the given ones are cast to bigint.  Every writer here conforms to a fixed
    schema, so schema merging (a footer read of every file) is off unless
    asked for."""
    if not path_exists(spark, path):
        raise TableNotFound(f"table not found at: {path}")
    try:
        r = spark.read
        if schema is not None and fmt != "parquet":
            r = r.schema(schema)
        if merge_schema:
            r = r.option("mergeSchema", "true")
        df = r.format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise TableNotFound(f"table not found at: {path}") from e
        if schema is not None and "UNABLE_TO_INFER_SCHEMA" in str(e):
            # A write of no rows leaves a folder without data files.
            return spark.createDataFrame([], schema)
        raise
    if schema is not None and fmt == "parquet" and not merge_schema:
        # The declared columns, whichever file's footer was asked: columns
        # that only later files have are read too (null in the others).
        declared = [f for f in df.schema.fields if f.name not in schema.fieldNames()]
        files = {f.name: f for f in df.schema.fields}
        parts = [files.get(f.name) if f.name in int_partitions else None for f in schema.fields]
        df = spark.read.schema(StructType([p or f for p, f in zip(parts, schema.fields)] + declared)).parquet(path)
    if where is not None:
        df = df.where(where)
    for c in int_partitions:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("bigint"))
    if schema is not None:
        from lakeledger.schemas import conform
        df = conform(df, schema)
    return df
