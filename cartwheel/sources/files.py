"""Files as rows: listings, Parquet footers and deletes, worked on by tasks.

Functions that tasks run are nested, so that they travel with the job; on a
cluster the package need not be installed on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import stage

#: The columns of Spark's binary file source.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
_PER_TASK = 1000


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def input_paths(df: DataFrame) -> list[str]:
    """The files that a scan will read: its listing, which was made with it."""
    return sorted(unquote(p) for p in df.inputFiles())


def path_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path)`` rows, over as many tasks as there are cores or thousands of paths."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-len(paths) // _PER_TASK))
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)


def _opener():
    """Finds a path's store among those that pyarrow knows."""
    def place(path: str):
        from urllib.parse import quote

        import pyarrow.fs as fs
        scheme, _, rest = path.partition(":/")
        return fs.FileSystem.from_uri(f"{scheme}://{quote('/' + rest.lstrip('/'))}" if scheme == "file" else quote(path, safe="/:"))
    return place


def footers(paths: DataFrame) -> DataFrame:
    """``(path, footer)`` of Parquet files, written once: their Arrow schema,
    serialised without metadata.  Tasks read the footers; files in a store that
    pyarrow does not know are read whole, by Spark."""
    place = _opener()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                try:
                    store, name = place(path)
                except Exception:  # no such store in pyarrow
                    found.append(None)
                    continue
                with store.open_input_file(name) as f:
                    found.append(pq.read_schema(f).remove_metadata().serialize().to_pybytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["path", "footer"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        for batch in batches:
            found = [pq.read_schema(pa.BufferReader(c.as_buffer())).remove_metadata().serialize().to_pybytes() for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["path", "footer"])

    found = stage(paths.select("path").mapInArrow(read, "path string, footer binary"), "footers")
    strange = [r.path for r in found.where("footer IS NULL").select("path").collect()]
    if not strange:
        return found
    whole = (paths.sparkSession.read.format("binaryFile").load(strange).select("path", "content")
             .mapInArrow(parse, "path string, footer binary"))
    return stage(found.where("footer IS NOT NULL").unionByName(whole), "footers")


def deleted(paths: DataFrame) -> DataFrame:
    """Delete the files of ``paths``; a row ``(path, error)`` for each that is
    still there.  A file that is gone is no error."""
    place = _opener()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, errors = [], []
            for path in batch.column(0).to_pylist():
                try:
                    store, name = place(path)
                    store.delete_file(name)
                except FileNotFoundError:
                    pass
                except Exception as e:
                    left.append(path)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()), pa.array(errors, pa.string())], names=["path", "error"])

    return paths.select("path").mapInArrow(remove, "path string, error string")
