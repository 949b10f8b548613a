"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from loomtally.operators.durable import durable, shared_folder


def fake(master, configured=None):
    folders = []
    context = SimpleNamespace(
        master=master, setCheckpointDir=folders.append,
        getCheckpointDir=lambda: folders[-1] if folders else None,
    )
    return SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda name, default: configured)
    )


def test_configured_folder_is_used():
    assert shared_folder(fake("spark://host:7077", "/shared/x")) == "/shared/x"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(ValueError):
        shared_folder(fake("spark://host:7077"))


def test_local_session_gets_one_scratch_folder():
    session = fake("local[2]")
    assert shared_folder(session) == shared_folder(session)


def test_rows_come_back_without_lineage(spark):
    kept = durable(spark.range(100).selectExpr("id", "2 * id AS x"))
    assert sorted(map(tuple, kept.collect())) == [(i, 2 * i) for i in range(100)]
    assert "Range" not in kept._jdf.queryExecution().logical().toString()


def test_shuffles_of_a_stored_table_are_removed(spark):
    """They stayed until the driver collected garbage, which large jobs may never live to see."""
    import os
    import time

    from loomtally.operators.durable import CLEANUP

    folders = [str(x) for x in spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()]

    def shuffled() -> set[str]:
        return {name for folder in folders for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(CLEANUP, None)
    stored = durable(spark.range(1000).repartition(5, "id"))
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and stored.count() == 1000
    assert spark.conf.get(CLEANUP, None) == setting
    # A frame that was stored can be worked out again.
    again = spark.range(100).repartition(3, "id")
    assert durable(again).count() == again.count() == durable(again).count() == 100
