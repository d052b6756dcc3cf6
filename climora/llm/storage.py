"""Written tables in the folder that all executors share, to cut lineage and to compute things once."""

from __future__ import annotations

import ctypes
import uuid
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.session import shared_folder


def new_folder(spark, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/climora-llm/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str, *by: str) -> DataFrame:
    """``frame`` written as Parquet in the shared folder, in folders ``by`` columns, and read back; survives lost executors."""
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.partitionBy(*by).parquet(path)
    back = spark.read.schema(frame.schema).parquet(path)
    back.climora_path = path
    return back


def dropped(frame: DataFrame) -> None:
    """Remove the files of a stored table that nothing reads any more."""
    path = getattr(frame, "climora_path", None)
    if path is not None:
        spark = frame.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def one_text_per_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns _climora_id, text and _climora_hash of labelled samples: group by id and take the text of the smallest hash.

    A sample that is bounded by its ids is then bounded by its rows, however often an id is repeated.
    """
    text = F.make_valid_utf8(text_col)
    return docs.select(F.col(id_col).cast("long").alias("_climora_id"), text.alias("text"), F.xxhash64(text).alias("_climora_hash"))


def parts_for(rows: int, per_task: int) -> int:
    """How many tasks so many rows are dealt to: what a row gives rise to may be far larger than the row."""
    return max(1, -(-rows // per_task))


def tidied(work):
    """``work`` for ``mapInArrow`` or as an iterator UDF; afterwards the worker, which stays for later tasks, gives back the memory it has freed."""

    @wraps(work)
    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim is not None:
            trim(0)

    return run


def small_batches(spark) -> None:
    """Bound what a Python worker is given at once, by rows and bytes, as documents can be long.

    A session setting that stays, as plans read it when they run. Smaller values that the session already has are kept.
    """
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1024), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        have = spark.conf.get(name)
        if not (have.isdigit() and 0 < int(have) <= most):
            spark.conf.set(name, str(most))
