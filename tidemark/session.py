"""Session helpers: a local builder for tests and bench, and the shared
work folder taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tidemark") -> SparkSession:
    """Session for local tools and tests, with a checkpoint folder of its own.
    Cluster jobs bring their session and a shared folder."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-ckpt-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.schemaInference", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Every time rule here is defined in UTC (event times are stored as
    TIMESTAMP_NTZ and are read as UTC instants)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key)
    except Exception:  # noqa: BLE001 - unset key
        return None


def app_id(spark: SparkSession) -> str:
    """Id of the Spark application (also under Spark Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext on Connect sessions
        return _conf(spark, "spark.app.id") or str(id(spark))


def parallelism(spark: SparkSession) -> int:
    """Cores available to the application (default parallelism)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(_conf(spark, "spark.default.parallelism")
                   or _conf(spark, "spark.sql.shuffle.partitions") or 8)


def _master(spark: SparkSession) -> str:
    return _conf(spark, "spark.master") or ""


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set to a durable shared path (HDFS / object
    store): a driver's own folder is not seen by executors, so an unset value
    raises there.  Only in local mode (tests) is a fresh scratch folder made.
    """
    root = _conf(spark, "spark.checkpoint.dir")
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        master = _master(spark)
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder under the shared root."""
    return f"{checkpoint_root(spark)}/tidemark/{app_id(spark)}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder of this application."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through its file system (nothing if it is not there)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, sorted; none if it is not there."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, whole or not at all: written aside, then renamed."""
    fs, p = _file_system(spark, path)
    aside = p.suffix(".part")
    out = fs.create(aside, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"could not write {path}")


def read_note(spark: SparkSession, path: str) -> str:
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application stored in its scratch folder.  Call it at
    the end, when no result that reads from it is needed any more."""
    delete_path(spark, scratch_root(spark))


def object_store_conf(endpoint: str, path_style: bool = True,
                      ssl: bool = True) -> dict[str, str]:
    """S3A settings for an S3-compatible store.  No credentials here: they
    come from the cluster's credential provider chain (environment,
    instance profile, secrets), never from code."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
