"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings the jobs are designed for. Shuffle partition counts are left to the
#: cluster: AQE coalesces them in batch jobs.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "touchline",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session with the recommended settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting a local master gets a folder of its own; a cluster is
    refused, since a machine-local folder would lose data with the machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="touchline-"))
    return context.getCheckpointDir().rstrip("/")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    path = f"{shared_root(spark)}/touchline/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file in any store that Spark can reach."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors import this package, from a zip file in the shared folder.

    Needed where Python runs in tasks; done once for an application.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    data = io.BytesIO()
    root = Path(__file__).parent
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    path = scratch_path(spark, "package") + ".zip"
    write_bytes(spark, path, data.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def clear_scratch(spark: SparkSession) -> None:
    """Remove this process's scratch data; its results must be consumed by then."""
    from touchline.sources.files import delete

    while _scratch:
        delete(spark, _scratch.pop())
