"""Session helpers: a tuned local session for tests/bench and the shared work folder.

Jobs that write intermediate tables (versioned tables, online-store state, stream
checkpoints) put them under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent *and* the master is local (tests, bench) do we
create one ourselves.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "featurekit") -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    for k, v in _LOCAL_CONF.items():
        b = b.config(k, v)
    n = shuffle_partitions or (8 if cpus == "*" else max(2, int(cpus) * 2))
    b = b.config("spark.sql.shuffle.partitions", str(n))
    b = b.config("spark.driver.memory", os.environ.get("FEATUREKIT_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Falls back to a fresh temp folder only on a local master, and records it as
    the session's checkpoint dir so ``DataFrame.checkpoint()`` uses it too.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises in some versions
            root = None
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/NFS) "
                           "before running featurekit jobs on a cluster")
    root = tempfile.mkdtemp(prefix="featurekit-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_SCRATCH: list[str] = []


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared root for one job run. Results may read it
    for as long as the application lives; it is removed when the application ends."""
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    path = f"{shared_root(spark)}/featurekit/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def _remove_scratch() -> None:
    """Deletes this application's run folders, if its session is still up."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    for path in _SCRATCH:
        try:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone already; nothing is lost
            return


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``featurekit`` importable in the Python workers (pandas UDFs,
    ``applyInPandas``, ``foreachPartition`` closures and broadcast models
    reference it). The package is zipped once per application into the shared
    root and added with ``addPyFile``; a cluster that already ships it with
    ``--py-files`` or an installed wheel loses nothing."""
    import io
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    dest = f"{shared_root(spark)}/featurekit/_pyfiles/featurekit-{app}.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(dest)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        out.write(bytearray(buf.getvalue()))
        out.close()
    sc.addPyFile(dest)
    _SHIPPED.add(app)
