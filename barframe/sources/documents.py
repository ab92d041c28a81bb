"""Stored bar documents: a schemaless collection kept as files.

A stored document is seven text fields (date, open, high, low, close, volume,
id). The collection is a directory of JSON lines; any other file format or a
document-store connector is a ``format(...)`` swap on the same DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RECORD_FIELDS

DOC_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RECORD_FIELDS])

def documents_from_events(events: DataFrame) -> DataFrame:
    """Fixture adapter: each event stored as a one-trade bar document (all text)."""
    v = F.col("value").cast("string")
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        v.alias("open"), v.alias("high"), v.alias("low"), v.alias("close"),
        F.col("user_id").cast("string").alias("volume"),
        F.col("event_id").cast("string").alias("id"),
    )


def write_collection(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    docs.select(*RECORD_FIELDS).write.mode(mode).json(path)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of the collection with an explicit all-text schema."""
    return spark.read.schema(DOC_SCHEMA).json(path)


def insert_json(text: DataFrame, col: str = "text") -> DataFrame:
    """The rows with ``fields`` MAP<STRING, STRING> and ``status``, in one pass.

    Any JSON object is a document, whatever its fields; its values are kept as
    text. Anything else (bad text, NULL, a JSON value that is no object) is
    'rejected' and keeps its raw text.
    """
    parsed = text.withColumn("fields", F.from_json(F.col(col), "MAP<STRING, STRING>", {"mode": "PERMISSIVE"}))
    return parsed.withColumn("status", F.when(F.col("fields").isNull(), "rejected").otherwise("inserted"))


def store_json(text: DataFrame, path: str, rejects_path: str, col: str = "text") -> None:
    """Append the accepted objects to the JSON-lines collection at ``path``, the raw text of the others to
    ``rejects_path``."""
    rows = insert_json(text, col)
    rows.filter("status = 'inserted'").select(F.to_json("fields").alias("value")).write.mode("append").text(path)
    rows.filter("status = 'rejected'").select(F.coalesce(F.col(col), F.lit("")).alias("value")) \
        .write.mode("append").text(rejects_path)


def read_sequenced(spark: SparkSession, path: str, name: str = "seq") -> DataFrame:
    """The collection with each document's place in it: file, start of the split it was read in, and line.

    Splits are dealt to tasks by size, so a task's rows do not follow the order of files, but within a split they do:
    the three together order the documents by file and line whatever the size of the splits.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                  F.monotonically_increasing_id().alias("line"))
    return read_collection(spark, path).select("*", at.alias(name))


def with_sequence(docs: DataFrame, name: str = "seq") -> DataFrame:
    """A unique number per row of ``docs`` in the order of its partitions. That is the order in which a frame was made,
    but not the order of files: see :func:`read_sequenced`, and ``DocumentStore`` for a collection that is changed."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def write_version(docs: DataFrame, path: str) -> str:
    """Write a mutated collection next to the versions before it; returns the new version's directory.

    ``path`` holds directories v=0, v=1, ...; a reader of an older version is not disturbed.
    """
    spark = docs.sparkSession
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    have = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    last = max([int(n[2:]) for n in have if n.startswith("v=") and n[2:].isdigit()], default=-1)
    out = f"{path.rstrip('/')}/v={last + 1}"
    write_collection(docs, out, mode="error")
    return out


def records_to_documents(records: DataFrame, col: str = "record") -> DataFrame:
    """Positional 7-string records (date, open, high, low, close, volume, id) to named fields."""
    return records.select(*[F.col(col).getItem(i).cast("string").alias(name) for i, name in enumerate(RECORD_FIELDS)])


def append_records(docs: DataFrame, records: DataFrame, col: str = "record") -> DataFrame:
    """The collection with the records appended (by name)."""
    return docs.select(*RECORD_FIELDS).unionByName(records_to_documents(records, col))
