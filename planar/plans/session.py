"""Session settings the operators rely on, and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings a cluster job should run with.  AQE re-plans joins at runtime
# (broadcast when a shuffled side turns out small, skew splitting for hot
# grid cells) and coalesces small shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffle partitions sized by bytes, not counts: AQE coalesces toward
    # this size, and a skewed partition is split when it is 5x the median
    # and above the threshold.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "planar") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    b = (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PLANAR_DRIVER_MEMORY", "16g"))
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared folder set by whoever runs the job; without
    it a cluster job fails here, with a clear message, rather than write to
    folders that other machines cannot see.  A local session (tests, bench)
    gets a fresh scratch folder.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if cur:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(cur)
        return cur
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="planar-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def conf_bytes(spark: SparkSession, key: str, default: int) -> int:
    """Read a byte-size setting such as ``10485760`` or ``10MB``; -1 disables."""
    raw = spark.conf.get(key, None)
    if raw is None:
        return default
    s = str(raw).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if s.endswith(suffix):
            return int(float(s[: -len(suffix)]) * units[suffix])
    return int(float(s))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``planar`` importable in the Python workers of this application.

    Stages that run Python (``mapInPandas``) pickle functions of this package
    by reference, so workers must be able to import it.  When it is not
    installed on the executors (a checkout run from elsewhere), a zip of the
    package is added with ``addPyFile`` once per application.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="planar-pkg-"), "planar.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
