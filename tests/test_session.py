from types import SimpleNamespace

import pytest

from folioscope import session


def fake(master, folder):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder),
        sparkContext=SimpleNamespace(master=master, applicationId="app"),
    )


def test_shared_folder_is_the_one_the_cluster_names():
    assert session.shared_dir(fake("yarn", "hdfs:///shared")) == "hdfs:///shared"
    one, two = (session.scratch_path(fake("yarn", "hdfs:///shared/"), "x") for _ in range(2))
    assert one.startswith("hdfs:///shared/x-") and one != two


def test_only_a_local_session_may_use_its_own_folder():
    local = fake("local[2]", None)
    assert session.shared_dir(local) == session.shared_dir(local)
    with pytest.raises(ValueError):
        session.shared_dir(fake("yarn", None))


def test_stable_keeps_rows_and_types(spark):
    from folioscope.plans.registry import table

    orders = table(spark, "/root/testdata/sf0.001", "orders")
    written = session.stable(orders)
    assert written.schema == orders.schema
    assert written.exceptAll(orders).isEmpty() and written.count() == orders.count()


def test_small_tables_are_marked_for_broadcast(spark, monkeypatch):
    def hinted(df):
        return "Hint" in df._jdf.queryExecution().logical().toString()

    assert hinted(session.broadcast_if_small(spark.range(10)))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 50)
    assert not hinted(session.broadcast_if_small(spark.range(10)))
    monkeypatch.undo()
    monkeypatch.setattr(session, "BROADCAST_ROWS", 9)
    assert not hinted(session.broadcast_if_small(spark.range(10)))
