"""Files whose columns change type: what fits the remembered schema is kept, the rest is rescued, nothing is lost."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column to text of the values that did not fit, with the file they came from under ``FILE_KEY``; NULL where all did.
RESCUED, FILE_KEY = "_rescued", "_file"
RESCUED_TYPE = T.MapType(T.StringType(), T.StringType())
#: Types a column may grow from and to without losing a value.
WIDER = {
    (T.ByteType, T.ShortType), (T.ByteType, T.IntegerType), (T.ByteType, T.LongType), (T.ShortType, T.IntegerType),
    (T.ShortType, T.LongType), (T.IntegerType, T.LongType), (T.FloatType, T.DoubleType),
}


def _same(one: T.DataType, other: T.DataType) -> bool:
    return one == other or (type(one) is type(other) and isinstance(one, (T.StringType, T.TimestampType)))


def _grows(old: T.DataType, new: T.DataType) -> bool:
    return (type(old), type(new)) in WIDER


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns in place, the wider of two types, unseen columns appended.

    A column whose types fit neither way keeps the old one, and a column for rescued values is added.
    """
    incoming = {f.name: f for f in new.fields}
    clash = False

    def one(field: T.StructField) -> T.StructField:
        nonlocal clash
        other = incoming.get(field.name, field)
        if _grows(field.dataType, other.dataType):
            return other
        clash = clash or not (_same(field.dataType, other.dataType) or _grows(other.dataType, field.dataType))
        return field

    known = set(old.fieldNames())
    fields = [*map(one, old.fields), *(f for f in new.fields if f.name not in known)]
    if clash and RESCUED not in {f.name for f in fields}:
        fields.append(T.StructField(RESCUED, RESCUED_TYPE))
    return T.StructType(fields)


def alike(spark: SparkSession, files: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    """The files in runs whose footers merge into one schema.

    All agree as a rule, and one distributed look at the footers says so; a list that does not merge is
    halved until its parts do, so the looks needed grow with the number of odd files only.
    """
    files = list(files)
    try:
        return [(files, spark.read.option("mergeSchema", "true").parquet(*files).schema)]
    except (PySparkException, Py4JJavaError):
        if len(files) == 1:  # unreadable, whatever the others hold
            raise
    half = len(files) // 2
    runs = alike(spark, files[:half]) + alike(spark, files[half:])
    joined: list[tuple[list[str], T.StructType]] = []
    for names, schema in runs:
        for held, other in joined:
            if other == schema:
                held.extend(names)
                break
        else:
            joined.append((list(names), schema))
    return joined


def remembered(old: T.StructType | None, runs: Sequence[tuple[list[str], T.StructType]]) -> T.StructType:
    """The schema after these files: the old one, or that of the first run, grown by all."""
    return reduce(merged_schema, [schema for _, schema in runs], old if old is not None else runs[0][1])


def _as_text(column: Column, kind: T.DataType) -> Column:
    nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(column) if nested else column.cast("string")


def fitted(rows: DataFrame, schema: T.StructType, file: Column) -> DataFrame:
    """Rows in the columns of ``schema``. A value that changes when read as its column's type is rescued."""
    arriving = {f.name: f.dataType for f in rows.schema.fields}
    columns, lost = [], []
    for field in schema.fields:
        if field.name == RESCUED:
            continue
        kind, name = arriving.get(field.name), field.name
        value = F.col(f"`{name}`") if kind is not None else F.lit(None)
        if kind is None or _same(kind, field.dataType) or _grows(kind, field.dataType):
            columns.append(value.cast(field.dataType).alias(name))
            continue
        nested = any(isinstance(t, (T.ArrayType, T.MapType, T.StructType)) for t in (kind, field.dataType))
        if nested:
            columns.append(F.lit(None).cast(field.dataType).alias(name))
            lost += [F.lit(name), _as_text(value, kind)]
            continue
        read = value.try_cast(field.dataType)
        fits = read.isNotNull()
        if not isinstance(kind, T.StringType):  # 3.7 read as a whole number would come back as 3
            fits = fits & F.coalesce(read.try_cast(kind) == value, F.lit(False))
        columns.append(F.when(fits, read).alias(name))
        lost += [F.lit(name), F.when(~fits, _as_text(value, kind))]
    if RESCUED in schema.fieldNames():
        found = F.map_filter(F.create_map(*lost), lambda _, v: v.isNotNull()) if lost else None
        rescued = F.lit(None) if found is None else F.when(
            F.size(found) > 0, F.map_concat(found, F.create_map(F.lit(FILE_KEY), file))
        )
        columns.append(rescued.cast(RESCUED_TYPE).alias(RESCUED))
    return rows.select(*columns)


def landed_rows(
    spark: SparkSession, runs: Sequence[tuple[list[str], T.StructType]], schema: T.StructType
) -> DataFrame:
    """The rows of all files in the columns of ``schema``; each run of files is read in its own types."""
    file = F.col("_metadata.file_path")
    parts = [fitted(spark.read.schema(found).parquet(*files), schema, file) for files, found in runs]
    return reduce(DataFrame.unionByName, parts)
