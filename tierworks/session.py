"""Where intermediate tables live.

Everything that has to outlive a task (staged tables, stream checkpoints, scored
text) is written below the shared folder the cluster names in
``spark.checkpoint.dir``, so a lost executor never takes it away.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tierworks-")
        context.setCheckpointDir(_LOCAL_FOLDERS[app])
    return _LOCAL_FOLDERS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, none if it does not exist."""
    files, handle = _folder(spark, path)
    if not files.exists(handle):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(handle) if s.isDirectory())


def delete_folder(spark: SparkSession, path: str) -> None:
    files, handle = _folder(spark, path)
    files.delete(handle, True)


# Settings the jobs are planned for; all can be changed at run time or at start.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    # Sizes are measured while running: small sides are broadcast, skewed
    # partitions are split, small ones are joined together.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Very wide projections (synthetic tables) run faster as several methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long texts fill a batch before 10,000 rows do.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024**2),
    # Call sites of every column expression cost several calls to the JVM each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configured(builder):
    """A session builder with the recommended settings."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder
