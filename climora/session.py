"""Session settings shared by the jobs, the tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Calendar days are UTC days throughout; ANSI makes strict casts raise.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A folder of our own is made only where the setting is absent, as in local tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    own = tempfile.mkdtemp(prefix="climora-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def observed(counts: Observation, *names: str) -> dict[str, int]:
    """Counts of an observation after its query; 0 for each of ``names`` where Spark left out the part of the plan, as no row came to it."""
    try:
        found = counts.get
    except Py4JJavaError:
        found = {}
    return {name: found.get(name) or 0 for name in names}


def staged(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written once in the shared folder and read back, for work that needs them several times."""
    path = f"{shared_folder(rows.sparkSession)}/staged-{label}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    back = rows.sparkSession.read.schema(rows.schema).parquet(path)
    back.staged_path = path
    return back


def discard(rows: DataFrame) -> None:
    """Remove the files of staged rows that nothing reads any more."""
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(rows.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
