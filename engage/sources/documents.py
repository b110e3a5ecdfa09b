"""Call transcripts as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from engage.functions import basename

TRANSCRIPT_SCHEMA = (
    "language string, mediaId string, status string, dateCreated string, contentType string, channels string, "
    "metadata map<string,string>, _corrupt_record string"
)


def parse_documents(df: DataFrame, body: str = "body", path: str = "path") -> DataFrame:
    """One row per document with the transcript's fields; ``error`` is set where the text is not JSON.

    Nested ``channels`` stay JSON text; every metadata value becomes text.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    kept = [c for c in df.columns if c not in (body, "error")]
    # a generator parses each text once, however many fields are used or filtered on later
    parsed = df.select(
        *kept,
        *([] if path == "path" else [F.col(path).alias("path")]),
        F.col(body).isNotNull().alias("_has_body"),
        F.inline(F.array(F.from_json(body, TRANSCRIPT_SCHEMA, options))),
    )
    bad = ~F.col("_has_body") | F.col("_corrupt_record").isNotNull()
    return parsed.withColumn("error", F.when(bad, F.lit("not a JSON document"))).drop("_has_body", "_corrupt_record")


def read_documents(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """All ``.json`` files of a folder, one row each, unreadable ones with ``error`` set."""
    files = (
        spark.read.option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", str(recursive).lower())
        .text(folder, wholetext=True)
    )
    return parse_documents(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")))


def readable(documents: DataFrame) -> DataFrame:
    return documents.where("error is null").drop("error")


def unreadable(documents: DataFrame) -> DataFrame:
    return documents.where("error is not null").select("path", "error")


def work_list(spark: SparkSession, folder: str, start_date: str | Column, retry_count: int = 1) -> DataFrame:
    """Every ``.json`` file below a folder: path, name, start date and retry count.  Contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return files.select(
        F.col("path").alias("transcript_path"),
        basename("path").alias("transcript_name"),
        (F.lit(start_date) if isinstance(start_date, str) else start_date).alias("start_date"),
        F.lit(retry_count).alias("retry_count"),
    )
