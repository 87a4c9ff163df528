"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
#: Temporary folders of applications of one process that name none.
_TEMPORARY: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, without a slash at its end.

    Only a session of one process (a test) gets a temporary folder where it names none; a cluster, whose
    executors would each write to their own disk, must name one.
    """
    found = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not found:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError(f"{_KEY} must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _TEMPORARY:
            _TEMPORARY[app] = "file://" + tempfile.mkdtemp(prefix="lectern-")
        found = _TEMPORARY[app]
    return found.rstrip("/")


def written(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows repeats nothing of what came before."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(at)
    return spark.read.schema(df.schema).parquet(at)
