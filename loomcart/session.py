"""Session settings and the few places where the library touches the cluster."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

def build_session(app: str = "loomcart", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current is None:
        if not configured:
            if not re.match(r"local(\[|$)", sc.master):  # not local-cluster
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="loomcart-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return configured or current


_scratch: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below this application's own folder, which is deleted when the driver's Python ends."""
    root = f"{shared_dir(spark).rstrip('/')}/loomcart/{spark.sparkContext.applicationId}"
    if root not in _scratch:
        _scratch.add(root)
        atexit.register(_delete, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def _delete(jvm, hadoop_conf, path: str) -> None:
    with contextlib.suppress(Exception):  # at the end the JVM may be gone
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop_conf).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that ``materialise`` returned, once nothing reads it any more."""
    sc = df.sparkSession.sparkContext
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        _delete(sc._jvm, sc._jsc.hadoopConfiguration(), folder)


def materialise(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so that iterative work on the result neither repeats the
    scan of the fact tables nor depends on blocks held by one executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, but at most the size of what the plan reads, for plans whose rows are those of one of
    their inputs: the optimizer multiplies the sizes of joined sides. A scan counts its files as they are compressed."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return min(int(plan.stats().sizeInBytes()), read)


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent
        _shipped.add(app)
        if not package.is_dir():
            return  # imported from an archive that the application already ships
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='loomcart-')}/{package.name}", "zip", package.parent, package.name
        )
        spark.sparkContext.addPyFile(archive)
