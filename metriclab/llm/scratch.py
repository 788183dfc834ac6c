"""Tables that cut lineage, kept in the folder the cluster shares.

``spark.checkpoint.dir`` names that folder.  A table written there survives the
loss of any executor, which a local checkpoint does not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for written tables; a temporary one only in local mode without a setting."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _OWN:
        _OWN[key] = tempfile.mkdtemp(prefix="metriclab-")
    return f"file://{_OWN[key]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that ``written`` made and nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for table in tables:
        for file in table.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
