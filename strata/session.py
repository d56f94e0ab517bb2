"""Session helpers: a local builder for tests/bench and checkpoint-dir lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata") -> SparkSession:
    """Local session for tests and benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from ``spark.checkpoint.dir`` (or the SparkContext); raises when the
    session has none, because a machine-local folder is not safe on a cluster.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - older API
            d = None
    if not d:
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir to a shared path")
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; only a local session (one machine, so
    one disk) that has none gets a fresh scratch folder.  On a cluster an unset
    folder raises: a folder of one machine is not seen by the others."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise
        d = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
        return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the session's checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def materialize(df, name: str = "table"):
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: lineage is cut (a lost executor costs a re-read, not a
    recomputation), and later passes get Parquet column pruning and filter
    pushdown on the written table."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._materialized_at = path
    return out


def release(df) -> None:
    """Delete the files of a frame that ``materialize`` returned, once what was
    made from it is written itself (nothing lazy may still read it)."""
    path = getattr(df, "_materialized_at", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file: what stands before it is complete once it exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    fs.create(p, True).close()


def marks(spark: SparkSession, folder: str) -> set[str]:
    """Names of the marks in a folder (none if there is no such folder)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(p)} if fs.exists(p) else set()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``strata`` importable in executor Python workers, once per
    application: the package is zipped on the driver and handed to
    ``SparkContext.addPyFile`` (Spark serves it to every executor, as
    ``--py-files`` would).  Task functions import ``strata`` modules, so
    jobs started from any working directory need this."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="strata-pyfiles-"), "strata.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
