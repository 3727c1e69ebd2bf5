"""Session helpers.

Cluster settings (master, memory, shuffle partitions, checkpoint directory)
belong to whoever submits the job. ``session`` builds a session from them and
fills in only what is unset; ``local_session`` is for tests and benchmarks.
"""

from __future__ import annotations

import os
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings the library recommends; used only where the submitter left them unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE replace a sort-merge join by a shuffled hash join when every
    # build-side partition measured at run time is under this size (no sort of
    # either side; the memory bound is checked, larger partitions keep SMJ).
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def _with_defaults(builder, given: SparkConf):
    for key, value in _DEFAULTS.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    return builder


def session(app: str = "kinship") -> SparkSession:
    """The session of the submitted job: master, memory and folders come from
    ``spark-submit`` or the cluster's configuration, never from here."""
    return _with_defaults(SparkSession.builder.appName(app), SparkConf()).getOrCreate()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kinship") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("KINSHIP_DRIVER_MEMORY", "8g"))
    )
    java_opts = os.environ.get("KINSHIP_DRIVER_JAVA_OPTIONS")
    if java_opts:
        builder = builder.config("spark.driver.extraJavaOptions", java_opts)
    spark = _with_defaults(builder, SparkConf()).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Let Python workers started from now on import this repository where its
    folder is visible (on a cluster without it: ``spark-submit --py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def shared_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, below the folder that
    the cluster shares: ``spark.checkpoint.dir``, else the directory set with
    ``SparkContext.setCheckpointDir``, else the SQL warehouse (also shared)."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    return f"{base.rstrip('/')}/kinship-{sc.applicationId}"


def cleanup(spark: SparkSession) -> None:
    """Delete every intermediate table this application has written. Results
    that were not yet written read those tables, so call it after the last action."""
    sc = spark.sparkContext
    for name in _BUCKETED.pop(sc.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    folder = sc._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the application's shared folder and read it back.

    For an expensive derived input that several branches of a plan read: the
    branches then scan columnar files (with column pruning and real size
    statistics for join planning) instead of re-running the derivation, and a
    lost executor costs a re-read, not a recomputation. ``cleanup`` removes it.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_table_path(df, name))


#: application id -> names of its bucketed tables in the session catalog
_BUCKETED: dict[str, list[str]] = {}


def write_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``write_table`` with the rows bucketed by ``key`` into as many buckets as there are
    shuffle partitions, one file each if ``df`` comes from ``dealt``: joins and groupings on ``key`` then
    need no shuffle."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{shared_folder(spark)}/{table}"
    _BUCKETED.setdefault(spark.sparkContext.applicationId, []).append(table)
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return spark.table(table)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt out as ``write_bucketed`` files it. Metrics observed on the result are
    collected in the tasks that write, where a retry never counts twice."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def write_table_path(df: DataFrame, name: str) -> str:
    """Write ``df`` as parquet under the application's shared folder; return the path."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return path
