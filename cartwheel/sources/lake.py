"""The Parquet lake of order-item and edit rows.

Landing (S6, S7) appends files written with the declared schema, so a
directory we wrote never holds two types for one column.  Lakes written by
per-batch pandas inference can disagree file to file (an integer column with a
null becomes double, a column of nulls has no type); Spark refuses such a
directory as one read.  ``read_lake`` therefore looks at the files' footers, in
tasks: files of the declared types are one scan, each other schema is one more,
cast to the declared types.  Batch runs and streams both read this way.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from ..plans.clean import lenient_cast
from ..schemas import LAKE_EDITS, LAKE_ITEMS
from . import files


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast/fill ``df`` to ``schema`` (missing columns -> null)."""
    source = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in source:
            cols.append(lenient_cast(F.col(f.name), source[f.name], f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def land_items(df: DataFrame, lake_dir: str) -> None:
    """Append one batch of item rows; load stamp floored to milliseconds."""
    out = conform(df, LAKE_ITEMS).withColumn(
        "ingested_at", F.date_trunc("millisecond", F.col("ingested_at")).cast("timestamp_ntz"))
    out.write.mode("append").parquet(lake_dir)


def land_edits(df: DataFrame, lake_dir: str) -> None:
    """Append one batch of edit rows."""
    conform(df, LAKE_EDITS).write.mode("append").parquet(lake_dir)


def _read_type(found: pa.DataType) -> T.DataType | None:
    """The Spark type to read a stored column as; None for a column without a type."""
    if pa.types.is_dictionary(found):
        found = found.value_type
    if pa.types.is_null(found):
        return None
    if pa.types.is_large_string(found) or pa.types.is_string_view(found):
        return T.StringType()
    if pa.types.is_unsigned_integer(found):  # stored in the next wider signed type
        return T.LongType() if found.bit_width < 64 else T.DecimalType(20, 0)
    if pa.types.is_timestamp(found) and found.tz is None:
        return T.TimestampNTZType()
    return from_arrow_type(found)


def _as_stored(footer: pa.Schema, schema: T.StructType) -> T.StructType:
    """The declared columns that a file holds, with the types it holds them in."""
    held = {f.name: _read_type(f.type) for f in footer}
    return T.StructType([T.StructField(f.name, held[f.name], True) for f in schema.fields if held.get(f.name) is not None])


def read_lake(spark: SparkSession, lake_dir: str, schema: T.StructType = LAKE_ITEMS,
              names: list[str] | None = None, skip: set[str] = frozenset()) -> tuple[DataFrame, list[str]]:
    """The folder's Parquet files as one table of the declared schema, and
    their paths; ``names`` restricts it to some, ``skip`` leaves paths out.

    What the result reads is fixed by the listing made here: files that land later
    are in neither.  No file is touched by the driver.  It learns the names of the
    files whose types are not the declared ones, and of the chosen ones.  An
    absent or empty folder, or no chosen file, gives no rows.
    """
    if names == [] or not files.exists(spark, lake_dir):
        return spark.createDataFrame([], schema), []
    name = F.col("_metadata.file_name")
    names = names and set(names)

    def scan(kind: T.StructType, chosen: list[str] | None = None) -> DataFrame:
        df = spark.read.schema(kind).option("pathGlobFilter", "*.parquet").parquet(lake_dir)
        return df if chosen is None else df.where(name.isin(chosen))

    whole = scan(schema)
    listed = files.input_paths(whole)
    paths = [p for p in listed if p not in skip and (names is None or p.rsplit("/", 1)[1] in names)]
    if not paths:
        return spark.createDataFrame([], schema), []
    declared = {f.name: f.dataType for f in schema.fields}
    footers = files.footers(files.path_rows(spark, paths))
    drifting: dict[T.StructType, list[str]] = defaultdict(list)
    for row in footers.groupBy("footer").agg(F.min("path").alias("sample")).collect():  # a row a schema
        footer = pa.ipc.read_schema(pa.BufferReader(row.footer))
        if any(f.name in declared and _read_type(f.type) != declared[f.name] for f in footer):
            found = footers.where(F.col("footer") == F.lit(row.footer)).select("path").collect()
            drifting[_as_stored(footer, schema)] += [r.path.rsplit("/", 1)[1] for r in found]
    strange = [n for group in drifting.values() for n in group]
    regular = whole if len(paths) == len(listed) else whole.where(name.isin([p.rsplit("/", 1)[1] for p in paths]))
    out = regular.where(~name.isin(strange)) if strange else regular
    out = out.select(*schema.names)
    for kind, group in drifting.items():
        out = out.unionByName(conform(scan(kind, group), schema))
    return out, paths
