"""Session factory."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession

from staylens.workspace import new_dir

# Only settings that change results (time zone) or let Spark adapt to the data
# at run time. Sizes such as shuffle partitions stay with the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(
    app_name: str = "staylens",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
    hive: bool = False,
) -> SparkSession:
    """Get or create a session; ``hive=True`` adds the Hive metastore catalog."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def package_zip() -> bytes:
    """This package as a zip archive that Python can import from."""
    root = Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, f"{root.name}/{file.relative_to(root).as_posix()}")
    return buffer.getvalue()


def ship_package(spark: SparkSession) -> str:
    """Let the executors import this package where it is not installed there; gives the archive's path.

    The archive goes to the shared folder, like everything else that executors read.
    """
    path = f"{new_dir(spark, 'package')}/staylens.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(bytearray(package_zip()))
    finally:
        stream.close()
    spark.sparkContext.addPyFile(path)
    return path
