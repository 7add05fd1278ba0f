"""Temporary tables go when they should."""

import os

import pytest

from rillstone.storage import clear, keep, materialize, remove, scratch, shared_root, write_table


def tables(spark):
    folder = f"{shared_root(spark)}/rillstone"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_scratch_tables_go_and_kept_ones_stay(spark):
    before = tables(spark)
    with scratch(spark) as outer:
        with scratch(spark) as inner:
            materialize(spark.range(3), "gone")
            kept, path = write_table(spark.range(4), "kept")
            keep(inner, path)
        assert outer == [path] and kept.count() == 4 and len(tables(spark) - before) == 1
    assert tables(spark) == before
    with pytest.raises(ZeroDivisionError), scratch(spark):
        materialize(spark.range(3), "gone")
        raise ZeroDivisionError
    assert tables(spark) == before


def test_clear_removes_all(spark, monkeypatch):
    import rillstone.storage as storage

    monkeypatch.setattr(storage, "shared_root", lambda spark, root=f"{shared_root(spark)}/own": root)
    materialize(spark.range(2), "one")
    assert tables(spark) is not None
    clear(spark)
    assert not os.path.exists(f"{storage.shared_root(spark)}/rillstone")
    remove(spark, storage.shared_root(spark))
