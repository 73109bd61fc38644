"""Readers and writers of letters, record files, statements and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def read_letters(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(source_file, year, text): whole files, the year from the first four digits of the name; files without one are
    skipped, and so are files of no bytes, which Spark's readers leave out."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select(F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("text"))
    return raw.withColumn("year", T.year_of_name(F.col("source_file"))).where("year is not null").select("source_file", "year", "text")


def read_records(spark: SparkSession, path: str, glob: str = "*.json", strict: bool = False) -> DataFrame:
    """(file, pos, json): the elements of JSON array files. A file that does not parse or is no array is one row whose
    json is its text, after "no array: " where it is JSON of another kind, so that validation reports it; strict raises
    instead."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select(F.col("_metadata.file_name").alias("file"), F.col("value"))
    whole = F.try_parse_json("value")
    is_array = F.coalesce(F.schema_of_variant(whole).startswith("ARRAY"), F.lit(False))
    elements = F.when(is_array, F.transform(F.from_json("value", "array<variant>"), lambda x: F.to_json(x)))
    if strict:
        elements = F.coalesce(elements, F.raise_error(F.concat(F.col("file"), F.lit(": not a JSON array"))).cast("array<string>"))
    # The text of a file that is one JSON value but no array would pass for an element.
    text = F.when(whole.isNull(), F.col("value")).otherwise(F.concat(F.lit("no array: "), F.col("value")))
    return raw.select("file", F.posexplode(F.coalesce(elements, F.array(text))).alias("pos", "json"))


def year_of_records(file: Column) -> Column:
    """The year of a record file's name, which has to be yyyy_chunks_2tier.json as a whole; else null."""
    return F.regexp_extract(file, r"^(\d{4})_chunks_2tier\.json$", 1).try_cast("int")


def one_letter(spark: SparkSession, path: str) -> DataFrame:
    """read_letters() of a single file; a missing one is an error at once."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        raise FileNotFoundError(path)
    return read_letters(spark, path, "*")


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """A statement CSV with its header's names made into identifiers; numbers become long where all digits, else double."""
    raw = spark.read.csv(path, header=True)
    clean = [F.col(f"`{c}`").alias("".join(x if x.isalnum() else "_" for x in c.lower()).strip("_")) for c in raw.columns]
    out = raw.select(*clean)
    return out.select(*[F.col(c) if c == "ticker" else F.col(c).try_cast("int" if "year" in c and "report" in c else "double").alias(c) for c in out.columns])


def write_records(df: DataFrame, path: str, partition: str | None = None) -> None:
    """JSON lines, a folder for each value of the partition column."""
    w = df.write.mode("overwrite")
    (w.partitionBy(partition) if partition else w).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def to_json_rows(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("json"))


def write_json_arrays(df: DataFrame, path: str, by: str | None = None) -> None:
    """One JSON array for each value of `by`, or for all rows, in the order of its column pos if there is one: a text file
    in a folder by=value. A file is one row, so this is for files of bounded size, as one year's records are."""
    order = [F.col("pos")] if "pos" in df.columns else []
    own = F.to_json(F.struct(*[c for c in df.columns if c != by]))
    rows = F.transform(F.array_sort(F.collect_list(F.struct(*order, own.alias("json")))), lambda r: r["json"])
    whole = df.groupBy(*([by] if by else [])).agg(F.concat(F.lit("[\n"), F.array_join(rows, ",\n"), F.lit("\n]")).alias("value"))
    w = whole.write.mode("overwrite")
    (w.partitionBy(by) if by else w).text(path)
