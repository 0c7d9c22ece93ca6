"""Input tables, stored intermediate results, and column helpers shared by the operators here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import scratch_dir

#: White space of the word contracts: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: The ASCII letters, for a lower-casing that leaves all other letters alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written below the shared scratch folder and read back, which cuts its lineage.

    Unlike cached blocks, the files outlive the executors that wrote them.
    """
    return stored_at(df, scratch_dir(df.sparkSession, purpose))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def unit(*parts: Column) -> Column:
    """A uniform number strictly between 0 and 1, fixed by its parts."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that clash with no column of the frame, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
