"""Incremental file loads: each landed file is taken exactly once, then the stream stops."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.sinks.versions import VersionedTable
from martloom.streaming.drift import RESCUED, alike, landed_rows

FILE = "_landed_file"


def one_form(path: Column) -> Column:
    """Local paths are written with one slash or three, depending on who lists them."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def stored_schema(spark: SparkSession, location: str) -> T.StructType | None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(location, wholetext=True).first()[0]))


def store_schema(spark: SparkSession, location: str, schema: T.StructType) -> None:
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(location)


def file_stream(
    spark: SparkSession, source: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(source)


def append_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append what has landed since the last run and wait for it.

    The checkpoint remembers finished files, so a second run adds nothing and a run cut short
    resumes where it stopped.
    """
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
        .awaitTermination()
    )


def load_new_files(
    spark: SparkSession,
    source: str,
    table: VersionedTable,
    checkpoint: str,
    ledger: str,
    schema: T.StructType,
    max_files: int | None = None,
) -> tuple[int, int]:
    """Add the files that neither the checkpoint nor the ledger knows; returns the rows added and those of
    them with a rescued value.

    A batch writes its rows to a folder of its own, then its files to the ledger, then a version of the table
    that holds both. A batch that runs again replaces all three, and entries of the ledger count only with
    a version that names their load: a failure at any point neither loses nor doubles a row, and a lost checkpoint
    costs one more look at the files that the ledger lists. Names of one batch's files come to the driver.
    """
    added, rescued = [], []
    generation = _generation(spark, checkpoint)
    stream = file_stream(spark, source, schema, max_files).select(one_form(F.col("_metadata.file_path")).alias(FILE))

    def load(batch: DataFrame, number: int) -> None:
        session, name = batch.sparkSession, f"{generation}-{number}"
        files = [r[FILE] for r in batch.distinct().collect()]
        version = table.version()
        loads = [p.rpartition("=")[2] for p in version.parts] if version else []
        if _exists(session, ledger):
            known = session.read.schema("file string, load string").parquet(ledger)
            known = known.filter(F.col("load").isin(*loads) & (F.col("load") != name) & F.col("file").isin(*files))
            taken = {r["file"] for r in known.collect()}
            files = [f for f in files if f not in taken]
        if not files:
            return
        rows = landed_rows(session, alike(session, sorted(files)), schema)
        count = Observation(f"load_{uuid.uuid4().hex}")
        figures = [F.count(F.lit(1)).alias("rows")]
        if RESCUED in schema.fieldNames():
            figures.append(F.count(RESCUED).alias("rescued"))
        listed = session.createDataFrame([(f,) for f in files], "file string").coalesce(1)
        listed.write.mode("overwrite").parquet(f"{ledger}/load={name}")
        note = {"loads": True} if version is None or version.note.get("loads") else {}
        table.append(rows.observe(count, *figures), schema, name, note)
        added.append(count.get["rows"])
        rescued.append(count.get.get("rescued", 0))

    (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return sum(added), sum(rescued)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _generation(spark: SparkSession, checkpoint: str) -> str:
    """A name kept beside the checkpoint; a new checkpoint counts its batches from zero again,
    so its folders must not take the names of the old one's."""
    meta = f"{checkpoint}/generation"
    if _exists(spark, meta):
        return spark.read.text(meta).first()[0]
    name = uuid.uuid4().hex[:12]
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(meta)
    return name
