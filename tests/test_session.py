"""Rules for the shared folder and the session defaults."""

import inspect

import kinship.session as session_mod
from kinship.session import cleanup, shared_folder, write_table_path


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return {"spark.checkpoint.dir": self.value, "spark.sql.warehouse.dir": "hdfs://w/"}.get(key) or default


class _Context:
    applicationId = "app-1"

    def __init__(self, current=None):
        self.current = current

    def getCheckpointDir(self):
        return self.current


class _Session:
    def __init__(self, conf_value, current=None):
        self.conf, self.sparkContext = _Conf(conf_value), _Context(current)


def test_configured_folder_is_used():
    assert shared_folder(_Session("hdfs://shared/ckpt")) == "hdfs://shared/ckpt/kinship-app-1"


def test_context_folder_is_used():
    assert shared_folder(_Session(None, "s3a://bucket/ckpt/x")) == "s3a://bucket/ckpt/x/kinship-app-1"


def test_warehouse_is_the_last_resort_and_no_machine_local_folder_is_made():
    assert shared_folder(_Session(None)) == "hdfs://w/_intermediate/kinship-app-1"
    assert "tempfile" not in inspect.getsource(session_mod)


def test_cleanup_removes_every_intermediate_table(spark):
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = write_table_path(spark.range(3), "t")
    assert spark.read.parquet(path).count() == 3
    cleanup(spark)
    assert not fs.exists(folder)
