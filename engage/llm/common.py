"""Tables, word pattern and written intermediate tables shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.session import scratch_dir

# A word is a run of anything but the ASCII space, tab, line feed, vertical tab, form feed and carriage return. This is
# also what ``bytes.split()`` yields on UTF-8.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BATCH_ROWS = 1000  # rows of an Arrow batch: texts of a few KB each are then a few MB on either side


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the memory of Arrow batches of texts in the session; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


READ_ROWS = 64  # rows of a batch of the Parquet reader, which keeps the texts of one, and twice their room while it grows


def small_reads(spark: SparkSession) -> SparkSession:
    """Bound the memory that the Parquet reader takes for texts in the session, however long they are; a smaller setting stays."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    if int(spark.conf.get(name)) > READ_ROWS:
        spark.conf.set(name, str(READ_ROWS))
    return spark


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone, whatever the locale or script."""
    return F.translate(text, UPPER, UPPER.lower())


def free_name(df: DataFrame, name: str) -> str:
    """A name like the given one that no column of the table has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Number of words of the whole text as bigint; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
