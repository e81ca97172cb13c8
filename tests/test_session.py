from __future__ import annotations

import pytest

from lakestrata import session


class FakeConf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class FakeContext:
    applicationId = "app-1"

    def __init__(self, master):
        self.master = master

    def getConf(self):
        return FakeConf()


class FakeSpark:
    def __init__(self, master, **conf):
        self.sparkContext = FakeContext(master)
        self.conf = FakeConf(conf)


def test_object_store_settings_leave_out_empty_credentials():
    conf = session.object_store_conf("https://store:9000")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "https://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert not [key for key in conf if "key" in key]
    assert session.object_store_conf("e", "a", "b")["spark.hadoop.fs.s3a.secret.key"] == "b"


def test_catalog_settings():
    assert session.catalog_conf("lake", "some.Catalog", "s3a://bucket/warehouse") == {
        "spark.sql.catalog.lake": "some.Catalog",
        "spark.sql.catalog.lake.warehouse": "s3a://bucket/warehouse",
    }


def test_work_folders_are_fresh_and_under_the_shared_folder(spark):
    first, second = (session.work_dir(spark, "x") for _ in range(2))
    shared = spark.conf.get("spark.checkpoint.dir")
    assert first != second and first.startswith(f"{shared}/x-")


def test_only_a_local_session_may_go_without_a_shared_folder():
    local = FakeSpark("local[2]")
    assert session.work_dir(local, "x").rsplit("/", 1)[0] == session.work_dir(local, "y").rsplit("/", 1)[0]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(FakeSpark("spark://host:7077"), "x")


def test_session_options_are_put_back(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    unset = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError):
        with session.session_conf(spark, {key: "1k", unset: "5"}):
            assert spark.conf.get(key) == "1k"
            raise RuntimeError
    assert spark.conf.get(key) == before
    assert spark.conf.get(unset) == "0"
