import pytest

from alambique import storage
from alambique.storage import run_together, scratch_path, scratch_root


class Session:
    """A session that only has settings."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_the_named_folder_is_used():
    session = Session(
        spark_checkpoint_dir="s3a://bucket/shared/", spark_master="yarn", spark_app_id="app-1"
    )
    assert scratch_root(session) == "s3a://bucket/shared"
    one, two = (scratch_path(session, "x") for _ in range(2))
    assert one.startswith("s3a://bucket/shared/alambique/app-1/x-") and one != two


def test_the_warehouse_where_none_is_named():
    session = Session(**{"spark_sql_warehouse_dir": "hdfs://cluster/warehouse"})
    assert scratch_root(session) == "hdfs://cluster/warehouse"
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        scratch_root(Session(spark_master="yarn"))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", None])
@pytest.mark.parametrize("warehouse", ["file:/home/user/spark-warehouse", "spark-warehouse", "/w", None])
def test_a_folder_of_the_drivers_machine_is_refused(master, warehouse):
    settings = {"spark_master": master, "spark_sql_warehouse_dir": warehouse}
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        scratch_root(Session(**{k: v for k, v in settings.items() if v}))


def test_local_mode_has_one_machine():
    session = Session(spark_master="local[8]", spark_sql_warehouse_dir="file:/home/user/warehouse")
    assert scratch_root(session) == "file:/home/user/warehouse"


def test_a_runs_folder_is_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(storage, "run_folder", lambda _: str(tmp_path / "run"))
    stored = storage.materialize(spark.range(3), "x")
    assert stored.count() == 3 and (tmp_path / "run").exists()
    assert storage.clear(spark)
    assert not (tmp_path / "run").exists()
    assert not storage.clear(spark)


def test_nested_columns_are_never_small(spark):
    nested = storage.materialize_measured(spark.sql("SELECT array(1, 2) AS a"), "nested")
    assert nested.rows == 1 and nested.size >= storage.UNMEASURED


def test_jobs_run_together(spark):
    jobs = {n: lambda n=n: spark.range(n).count() for n in (3, 5)}
    assert run_together(jobs) == {3: 3, 5: 5}
    assert run_together({}) == {}

    def fail():
        raise KeyError("boom")

    with pytest.raises(KeyError, match="boom"):
        run_together({"bad": fail})
