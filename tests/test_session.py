from __future__ import annotations

import threading
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gristmill import session
from gristmill.session import Scope, scratch, stage


def test_interleaved_scopes_keep_their_tables(spark):
    """Each thread's scope drops only its own tables, whichever closes first."""
    opened, closed, seen = threading.Event(), threading.Event(), []

    def other():
        with scratch(spark):
            stage(spark.range(3), "other").count()
            opened.set()
            closed.wait(60)

    thread = threading.Thread(target=other)
    with scratch(spark):
        thread.start()
        opened.wait(60)
        mine = stage(spark.range(5), "mine")
        closed.set()
        thread.join()
        seen.append(mine.count())
    assert seen == [5]


def test_close_leaves_nothing(spark):
    root = Path(session.staging_root(spark).removeprefix("file:")) / "gristmill"
    before = set(root.iterdir()) if root.exists() else set()
    scope = Scope(spark)
    assert scope.stage(spark.range(4), "a").count() == 4
    assert len(set(root.iterdir()) - before) == 1
    scope.close()
    assert set(root.iterdir()) == before


def test_no_machine_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.staging_root(SimpleNamespace(conf=conf, sparkContext=context))


def test_overlapping_writes_restore_the_setting(spark):
    before = spark.conf.get(session.FREE_SHUFFLES, None)
    first, second = session.freeing_shuffles(spark), session.freeing_shuffles(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(session.FREE_SHUFFLES) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(session.FREE_SHUFFLES, None) == before


def test_batches_of_long_texts_carry_few_bytes(spark):
    from gristmill.shipping import BATCH, ship

    spark.conf.unset(BATCH)
    ship(spark)
    long = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    sizes = long.mapInArrow(lambda batches: (b.select([]).from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert max(r.n for r in sizes) < 10_000_000
    spark.conf.set(BATCH, "16m")
    ship(spark)
    assert spark.conf.get(BATCH) == "16m"
    spark.conf.unset(BATCH)
