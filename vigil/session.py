"""Session helpers: one place for the settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator assumes: UTC clock (timestamps in the progress
# documents are UTC), AQE on (coalesces small shuffles, splits skewed join
# partitions, turns small joins into broadcasts after measuring them).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vigil") -> SparkSession:
    """A local session for tests, the bench and the examples."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.schemaInference", "false")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to an existing session and make the
    package importable on executors (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Ship this package to the executors' Python workers (``addPyFile``),
    once per SparkContext.  The grouped pandas functions (re-arm fold,
    streaming per-stream state) are imported there by module name; a
    cluster job would pass the same archive with ``--py-files``."""
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the package is deployed with the job
        return
    if getattr(sc, "_vigil_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="vigil-pkg-"), "vigil.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(archive)
    sc._vigil_shipped = True


_LOCAL_CHECKPOINT_DIR: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local master (tests) gets a scratch folder when it is
    unset; a cluster without one is an error, since executors and driver
    share no other folder."""
    global _LOCAL_CHECKPOINT_DIR
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = None
    try:
        sc = spark.sparkContext
        d = sc.getCheckpointDir()
    except Exception:  # no SparkContext (remote session)
        d = None
    if d:
        return d
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _LOCAL_CHECKPOINT_DIR is None:
        _LOCAL_CHECKPOINT_DIR = tempfile.mkdtemp(prefix="vigil-ckpt-")
    try:
        spark.conf.set("spark.checkpoint.dir", _LOCAL_CHECKPOINT_DIR)
    except Exception:  # core conf not settable at runtime
        pass
    if sc is not None:
        sc.setCheckpointDir(_LOCAL_CHECKPOINT_DIR)
    return _LOCAL_CHECKPOINT_DIR


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub folder of the shared checkpoint folder for stream checkpoints
    and staged tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def cluster_settings(total_cores: int, shuffle_bytes_hint: int | None = None) -> dict[str, str]:
    """Settings for a large cluster, to pass to the session builder or the
    job submission (they are not applied here).

    * shuffle partitions: about 3 per core, or shuffle bytes / 200 MB when
      the shuffle size is known, so a partition fits an executor's memory;
      AQE then coalesces small ones and splits skewed join partitions.
    * 256 MB input splits for the parquet scans.
    """
    parts = 3 * total_cores
    if shuffle_bytes_hint:
        parts = max(parts, shuffle_bytes_hint // (200 * 1024 * 1024))
    return {
        **REQUIRED_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
