"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder where it is unset, in local mode only."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="factloom-")
        spark.sparkContext.setCheckpointDir(_own[app])
    return _own[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage is cut, and a lost executor costs nothing that is written."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` made. What was made of them must be written, too."""
    for t in tables:
        folder = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.written_at)
        folder.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def bounded(rows: DataFrame, most: int = 500) -> DataFrame:
    """rows in a session of its own, with the settings of its session now but at most so many rows in an Arrow batch: what Python holds of long texts doesn't grow with the table."""
    spark = rows.sparkSession
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(most))
    view = f"factloom_{uuid.uuid4().hex}"
    rows.createGlobalTempView(view)
    out = own.table(f"global_temp.{view}")
    spark.catalog.dropGlobalTempView(view)
    return out
