"""Session defaults and the shared work folder.

Intermediate tables (checkpoints, the materialised gold layer) go under the
folder named by ``spark.checkpoint.dir``.  On a cluster that setting must point
to shared storage; only a local master may fall back to a fresh temporary
folder (tests, the bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and partition counts from
# runtime sizes, splits skewed sort-merge partitions, and coalesces small ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pitchhouse", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the scale defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "8g"  # local mode: the driver JVM holds the executors
        # a fresh catalog folder: the local catalog is per session, its files are not
        conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="pitchhouse-warehouse-")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` when the cluster sets it.  A local session
    without it gets a fresh temporary folder; a cluster session without it is
    an error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it to a shared folder")
        configured = tempfile.mkdtemp(prefix="pitchhouse-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, under the checkpoint dir."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pitchhouse`` importable in the executors' Python workers (needed
    by the few Arrow-batched Python steps, e.g. the CSV header read): zip the
    package once per application into the shared checkpoint folder and hand
    it to ``SparkContext.addPyFile``, which distributes it with the job."""
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    target = work_dir(spark, "pyfiles") + "/pitchhouse.zip"
    if target.startswith("file:") or "://" not in target:
        local = "/" + target[len("file:"):].lstrip("/") if target.startswith("file:") else target
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as f:
            f.write(buf.getvalue())
        target = local
    else:
        try:
            from pyarrow import fs
            filesystem, path = fs.FileSystem.from_uri(target)
            with filesystem.open_output_stream(path) as f:
                f.write(buf.getvalue())
        except Exception:  # a Hadoop-only scheme pyarrow cannot write:
            # hand Spark a driver-side file; addPyFile serves it to the executors
            target = os.path.join(tempfile.mkdtemp(prefix="pitchhouse-pyfiles-"), "pitchhouse.zip")
            with open(target, "wb") as f:
                f.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
