import pytest

from paneflow import session


class Conf(dict):
    """A session as far as ``scratch_root`` looks at it."""

    @property
    def conf(self):
        return self


def test_intermediates_go_to_the_folder_the_session_names():
    named = Conf({"spark.checkpoint.dir": "hdfs://n/c/", "spark.master": "yarn"})
    assert session.scratch_root(named) == "hdfs://n/c"
    first, second = (session.scratch_path(named, "x") for _ in range(2))
    assert first.startswith("hdfs://n/c/paneflow/x-") and first != second


def test_a_session_that_names_none_uses_its_warehouse():
    assert session.scratch_root(Conf({"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/w/"})) == "file:/w"
    assert session.scratch_root(Conf({"spark.master": "yarn", "spark.sql.warehouse.dir": "hdfs://n/w"})) == "hdfs://n/w"


@pytest.mark.parametrize("master", ["spark://h:7077", "local-cluster[3,2,3000]"])
def test_a_cluster_with_a_local_warehouse_must_name_a_shared_folder(master):
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_root(Conf({"spark.master": master, "spark.sql.warehouse.dir": warehouse}))


def test_what_is_written_keeps_its_types(spark):
    frame = spark.sql("select timestamp_ntz'2024-01-01 10:00:00' a, timestamp'2024-01-01' b, 1 c, cast(null as string) d")
    back = session.written(frame, "types")
    assert back.dtypes == frame.dtypes and back.collect() == frame.collect()
    assert "paneflow/types-" in back.inputFiles()[0]
