"""Incremental arrival: chunking as files come, deduplicated snapshots and a yearly fold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import segment as S


def stream_chunks(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """A stream of chunks of Parquet documents that arrive under path; stateless, so the batch columns serve as they are."""
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return docs.select("doc_id", F.posexplode(S.pack_paragraphs(T.lines(F.coalesce("text", F.lit(""))))).alias("chunk_no", "content"))


def run_once(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Take what is there, append it to out and stop; a later call goes on after it."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def fold_master(master: DataFrame | None, items: DataFrame, key: str = "item", year: str = "year") -> DataFrame:
    """master(t+1) from master(t) and a year's items: the years in which each item was seen, the first and last of them and
    their number. A year that is folded again counts once."""
    new = items.groupBy(key).agg(F.collect_set(year).alias("years"))
    if master is not None:
        new = master.select(key, "years").unionByName(new).groupBy(key).agg(F.array_distinct(F.flatten(F.collect_list("years"))).alias("years"))
    years = F.array_sort("years")
    return new.select(key, years.alias("years"), F.array_min("years").alias("first_year"), F.array_max("years").alias("last_year"), F.size("years").cast("long").alias("n_years"))


def reuse_snapshot(spark: SparkSession, path: str, make) -> DataFrame:
    """The table under path if it is there, else what make() returns, written there first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))
    if not there:
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def append_log(entries: DataFrame, path: str) -> None:
    """Entries with the time at which they are written, behind those that are there."""
    entries.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)
