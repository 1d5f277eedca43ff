"""Session helpers: defaults that matter for correctness and scale."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every query in this package relies on.  Time zone UTC makes
# timestamp arithmetic match the reference's UTC-localised frames; AQE gives
# runtime partition coalescing and skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "recoloom", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("RECOLOOM_DRIVER_MEM", "16g")))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``recoloom`` importable in the Python workers (pandas UDF kernels
    reference its functions): zip the package on the driver and register it
    with ``addPyFile`` — Spark distributes it to every executor, as
    ``--py-files`` would.  Done once per SparkContext."""
    sc = spark.sparkContext
    if getattr(sc, "_recoloom_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="recoloom-pyfiles-"), "recoloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._recoloom_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` must name a folder that driver and
    executors share.  Only a ``local`` master, whose executors run in the driver's
    own process, gets a scratch folder when it is unset.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {sc.master})")
        conf_dir = tempfile.mkdtemp(prefix="recoloom-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def apply_base_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings above on an existing session; static ones
    belong to whoever started it."""
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
