"""Session settings and the folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffles at run time from this many small pieces;
# on a cluster set spark.sql.shuffle.partitions to about 3 x cores instead.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
    # Without a stack trace per column expression, plans build in half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``.

    Only a master of one process may do without the setting: its machine's temporary
    folder is then visible to every task. The folders are for the storage's retention
    rules to remove; a job that is done leaves them.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")
