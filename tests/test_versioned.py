import os
import threading

import pytest

from fleetlake.operators import audit
from fleetlake.sinks import files, versioned
from fleetlake.streaming import ingest

DDL = "a long, b string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def rows(spark, path, **bounds):
    return sorted((r.a, r.b) for r in versioned.read_snapshot(spark, path, DDL, **bounds).collect())


def test_a_batch_is_visible_whole_or_not_at_all(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "t")
    assert rows(spark, path) == []
    assert versioned.commit(frame(spark, (1, "x"), (2, "y")), path, 0)
    publish = versioned._publish

    def killed(*a, **k):
        raise RuntimeError("killed between write and commit")

    monkeypatch.setattr(versioned, "_publish", killed)
    with pytest.raises(RuntimeError, match="killed"):
        versioned.commit(frame(spark, (3, "z"), (4, "lost")), path, 1)
    monkeypatch.setattr(versioned, "_publish", publish)
    assert os.path.isdir(f"{path}/batch_id=1") and rows(spark, path) == [(1, "x"), (2, "y")]
    assert versioned.commit(frame(spark, (3, "z")), path, 1)            # the repeat replaces what was left
    assert rows(spark, path) == [(1, "x"), (2, "y"), (3, "z")]
    assert not versioned.commit(frame(spark, (9, "again")), path, 1)    # a repeat after the commit
    assert versioned.commit(frame(spark, (7, "new")), path, 2, replace=True)
    assert rows(spark, path) == [(7, "new")]
    assert versioned.commit(frame(spark), path, 3) and rows(spark, path) == [(7, "new")]


def test_of_two_writers_one_wins(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "t")
    versioned.commit(frame(spark, (1, "x")), path, 0)
    store = versioned._store

    def slow(*a, **k):
        out = store(*a, **k)
        monkeypatch.setattr(versioned, "_store", store)
        versioned.commit(frame(spark, (2, "first")), path, 1)           # another writer is quicker
        return out

    monkeypatch.setattr(versioned, "_store", slow)
    with pytest.raises(versioned.CommitConflict):
        versioned.commit(frame(spark, (2, "second")), path, 2)
    assert rows(spark, path) == [(1, "x"), (2, "first")]


def test_bounds_skip_folders_and_merging_keeps_rows(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    for n in range(20):
        versioned.commit(frame(spark, (10 * n, "lo"), (10 * n + 5, "hi")), path, n, bound="a")
        versioned.compact(spark, path, DDL, bound="a", width=4, order=["a"])
        live = versioned.manifest(spark, path)["folders"]
        assert len(live) <= 3 * 3 and sum(f["rows"] for f in live) == 2 * n + 2
    assert rows(spark, path) == sorted((10 * n + k, b) for n in range(20) for k, b in ((0, "lo"), (5, "hi")))
    some = rows(spark, path, lo=190, hi=195)
    assert (190, "lo") in some and (0, "lo") not in some
    assert rows(spark, path, lo=10_000, hi=10_001) == []
    kept = [n for n in os.listdir(path) if not n.startswith("_")]
    assert len(kept) <= len(live) + 2 * versioned.GRACE + 8             # replaced folders are removed in time


def test_folders_stay_few_over_many_batches():
    """The merge plan alone, over 5,000 batches of uneven size."""
    folders, most = [], 0
    for n in range(5000):
        folders.append({"name": n, "rows": 1 + (n * 7919) % 3000, "lo": n, "hi": n})
        while group := versioned.merge_plan(folders):
            folders = [f for f in folders if f not in group] + [
                {"name": -n, "rows": sum(f["rows"] for f in group), "lo": 0, "hi": n,
                 "merges": 1 + max(f.get("merges", 0) for f in group)}]
        most = max(most, len(folders))
    assert most <= 7 * 6 and sum(f["rows"] for f in folders) == sum(1 + (n * 7919) % 3000 for n in range(5000))


def test_runs_of_two_writers_are_ordered(spark, tmpdir_path):
    path, failed = os.path.join(tmpdir_path, "runs"), []

    def write(who):
        try:
            for n in range(8):
                audit.register_run(spark, "batch", "OK", f"{who}-{n}", n, path=path)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(w,)) for w in "ab"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert audit.register_run(spark, "other", "ERROR", path=path) == 1
    got = audit.registered_runs(spark, path).where("proceso = 'batch'").collect()
    assert not failed and [r.orden for r in got] == list(range(1, 17))
    for w in "ab":
        assert [r.detalles for r in got if r.detalles[0] == w] == [f"{w}-{n}" for n in range(8)]
    last = audit.latest_runs(audit.registered_runs(spark, path)).where("proceso = 'batch'").first()
    assert last.detalles == got[-1].detalles and last.timestamp is not None
    assert audit.can_run(audit.registered_runs(spark, path), "batch")[0]


def test_named_views_follow_appended_rows(spark, tmpdir_path):
    import datetime as dt
    t = dt.datetime(2024, 1, 5, 10, 0, 5)
    row = ("v1", "B1", "210", "210", 20.0, -33.45, -70.66, 10, "Friday", "Moderado", "Despejado", 14.0, t)
    name = "posiciones_vistas"
    files.replace_table(spark.createDataFrame([row], ingest.POSITION_SCHEMA), name, path=os.path.join(tmpdir_path, "t"))
    views = files.create_quality_views(spark, name, prefix="prueba_")
    assert views[0] == "prueba_analytics_congestion_stream" and spark.table(views[0]).first().total_pings == 1
    assert [spark.table(v).count() for v in views] == [1, 0, 0, 0]
    more = [row[:4] + (150.0,) + row[5:], row[:4] + (20.0, -35.0) + row[6:], row[:4] + (None, None) + row[6:]]
    files.append_rows(spark.createDataFrame(more, ingest.POSITION_SCHEMA), name)
    assert [spark.table(v).count() for v in views] == [1, 1, 1, 1]
    live = spark.table(views[0]).first()
    assert (live.total_pings, live.buses_unicos, live.velocidad_max, live.velocidad_promedio) == (4, 1, 150.0, 63.33)
    assert spark.table(views[1]).first().apariciones == 4
    files.replace_view(spark.table(name).limit(0), "vista_vacia")
    assert spark.table("vista_vacia").count() == 0
