"""Versions of a target: all of a load or nothing, whatever step it dies at."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import types as T
from test_load import facts, values

from alambique.operators import load
from alambique.plans.versioned_load import VersionedTarget
from alambique.sinks import versions
from alambique.sinks.versions import Conflict, Part, Version, VersionedTable
from alambique.storage import run_folder

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("m", T.StringType())])


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), ["m"])


def add(table, before, *rows):
    part = table.write(frame(table.spark, *rows), "filas")
    return table.publish(before, parts=(*before.parts, part))


def test_readers_stay_at_their_version(table):
    assert table.latest() == Version() and table.read(Version(), "filas", SCHEMA).isEmpty()
    first = add(table, table.latest(), (1, "a"))
    pinned = table.read(first, "filas", SCHEMA)
    second = add(table, first, (2, "b"), (3, None))
    assert values(pinned) == [(1, "a")]
    assert values(table.read(second, "filas", SCHEMA)) == [(1, "a"), (2, "b"), (3, None)]
    assert table.latest() == second and table.version(1) == first


def test_only_one_of_two_writers_gets_the_next_version(table):
    first = add(table, table.latest(), (1, "a"))
    part = table.write(frame(table.spark, (9, "x")), "filas")
    add(table, first, (2, "b"))
    with pytest.raises(Conflict):
        table.publish(first, parts=(*first.parts, part))
    assert values(table.read(table.latest(), "filas", SCHEMA)) == [(1, "a"), (2, "b")]
    assert table.numbers() == [1, 2]


def test_many_writers_at_once(spark, table):
    def one(i):
        while True:
            before = table.latest()
            try:
                return table.publish(before, parts=(*before.parts, Part(str(i), "filas")))
            except Conflict:
                pass

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(one, range(30)))
    assert {p.name for p in table.latest().parts} == set(map(str, range(30)))
    assert table.latest().number == 30


def test_merging_keeps_the_rows(table, monkeypatch):
    monkeypatch.setattr(versions, "FANOUT", 3)
    for i in range(9):
        add(table, table.latest(), (i, "ab"[i % 2]))
        table.compact("filas", SCHEMA)
        table.compact("filas", SCHEMA)
        table.vacuum()
    version = table.latest()
    assert [p.rank for p in version.parts] == [2]
    assert [k for k, _ in values(table.read(version, "filas", SCHEMA))] == list(range(9))


def test_a_thousand_loads_leave_a_short_record(table, monkeypatch):
    """Records and folders named by them stay few; a load's work on them too."""
    merges, folders = [], set()
    monkeypatch.setattr(table, "_rows", lambda parts, schema: len(parts))

    def write(rows, kind, rank=0):
        merges.append(rank)
        part = Part(f"{len(merges)}", kind, rank)
        folders.add(part)
        return part

    monkeypatch.setattr(table, "write", write)
    monkeypatch.setattr(table, "_folder", lambda part: part)
    monkeypatch.setattr(versions, "delete", lambda spark, part: folders.discard(part))
    for i in range(1000):
        before = table.latest()
        taken = (f"file-{i}",)
        table.publish(before, parts=(*before.parts, table.write(None, "filas")), taken=taken)
        for _ in range(2):
            table.compact("filas", SCHEMA)
        table.vacuum()
        most = 3 * (versions.FANOUT - 1) + 1
        assert len(table.latest().parts) <= most and len(table.latest().taken) == 1
        assert len(table.numbers()) <= versions.KEPT
    assert len(folders) <= most + 2 * versions.FANOUT + versions.KEPT
    assert sum(r > 0 for r in merges) <= 1000 / (versions.FANOUT - 1)


def test_folders_of_dead_loads_are_removed(table):
    version = add(table, table.latest(), (1, "a"))
    table.write(frame(table.spark, (5, "x")), "filas")
    assert table.remove_orphans(10**9) == 0
    assert table.remove_orphans(0) == 1
    assert values(table.read(version, "filas", SCHEMA)) == [(1, "a")]


# -- Loads --------------------------------------------------------------------

OLD = [(1, 1, "20240101", "A", 1), (2, 1, "20240201", "A", 1)]
NEW = [(2, 1, "20240201", "A", 5), (3, 1, "20240301", "A", 5), (None, 1, "20240301", "A", 7)]


def stage(spark, path, rows):
    facts(spark, rows).coalesce(1).write.mode("append").parquet(path)


def state(target, staged):
    volumes = sorted(r.Ventas_Volumen for r in target.remainder(staged).collect())
    return sorted(r.Producto_ID for r in target.read().collect()), volumes


def test_load_and_remainder(spark, tmp_path):
    staged, target = str(tmp_path / "in"), VersionedTarget(spark, str(tmp_path / "out"))
    assert target.load(staged) is None
    stage(spark, staged, OLD)
    assert state(target, staged) == ([], [1, 1])
    assert target.load(staged).first().Registros_Insertados == 2
    stage(spark, staged, NEW)
    counts = target.load(staged).first()
    assert (counts.Registros_Insertados, counts.Registros_Existentes) == (1, 1)
    assert counts.Registros_Errores == 1
    assert state(target, staged) == ([1, 2, 3], [7])
    assert not [n for n in os.listdir(staged) if n.endswith(".parquet")]
    plan = target.read(months=["202402"])._jdf.queryExecution().executedPlan().toString()
    assert "Mes_Carga" in plan and target.read(months=["202402"]).count() == 1


@pytest.mark.parametrize("nth", range(6))
def test_a_load_that_dies_leaves_the_old_or_the_new_state(spark, tmp_path, monkeypatch, nth):
    """Each call that changes a file, killed before and after it has done so."""
    staged, target = str(tmp_path / "in"), VersionedTarget(spark, str(tmp_path / "out"))
    stage(spark, staged, OLD)
    target.load(staged)
    stage(spark, staged, NEW)
    before, after = ([1, 2], [5, 5, 7]), ([1, 2, 3], [7])
    assert state(target, staged) == before
    store, calls = target.store, []

    def dying(name, real):
        def call(*args, **more):
            calls.append(name)
            if len(calls) - 1 == nth // 2 + 1 and nth % 2 == 0:
                raise KeyboardInterrupt(name)
            result = real(*args, **more)
            if len(calls) - 1 == nth // 2 + 1:
                raise KeyboardInterrupt(name)
            return result

        return call

    for name in ("write", "publish", "delete_taken"):
        monkeypatch.setattr(store, name, dying(name, getattr(store, name)))
    with pytest.raises(KeyboardInterrupt):
        target.load(staged)
    monkeypatch.undo()
    published = calls.count("publish") and (calls[-1] != "publish" or nth % 2)
    again = VersionedTarget(spark, str(tmp_path / "out"))
    assert state(again, staged) == (after if published else before)
    again.load(staged)
    assert state(again, staged) == after


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "FANOUT", 2)
    staged, target = str(tmp_path / "in"), VersionedTarget(spark, str(tmp_path / "out"))
    for rows in (OLD, NEW):
        stage(spark, staged, rows)
        target.load(staged)
    before = state(target, staged)
    for name in ("write", "publish"):
        with monkeypatch.context() as patch:
            patch.setattr(target.store, name, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                target.tidy()
        assert state(target, staged) == before
    target.tidy()
    assert state(target, staged) == before
    assert [p.rank for p in target.store.latest().of("filas")] == [1]


def test_two_loads_of_the_same_files(spark, tmp_path, monkeypatch):
    staged, root = str(tmp_path / "in"), str(tmp_path / "out")
    one, other = VersionedTarget(spark, root), VersionedTarget(spark, root)
    stage(spark, staged, OLD)
    publish = one.store.publish

    def late(*args, **more):
        other.load(staged)
        return publish(*args, **more)

    monkeypatch.setattr(one.store, "publish", late)
    with pytest.raises(Conflict):
        one.load(staged)
    assert state(one, staged) == ([1, 2], [])


@pytest.mark.parametrize("policy", [load.KEEP_ALL, load.KEEP_FIRST])
def test_drain_in_batches(spark, tmp_path, monkeypatch, policy):
    monkeypatch.setattr(versions, "FANOUT", 3)
    staged, target = str(tmp_path / "in"), VersionedTarget(spark, str(tmp_path / "out"))
    for i in range(7):
        stage(spark, staged, [(i, 1, "20240101", "A", i), (None, i, "20240101", "A", 70 + i)])
    assert target.drain(staged, policy, files_per_batch=1) == 7
    assert state(target, staged) == (list(range(7)), list(range(70, 77)))
    assert len(target.store.latest().of("filas")) <= 5
    assert target.drain(staged, policy) == 0


def test_a_load_writes_rows_once(spark, tmp_path):
    """Neither staged rows nor all of them with their state are stored besides the target."""
    staged, target = str(tmp_path / "in"), VersionedTarget(spark, str(tmp_path / "out"))

    def copies():
        folder = run_folder(spark)
        names = os.listdir(folder) if os.path.isdir(folder) else []
        return sorted(n for n in names if n.startswith(("staged-", "marked-", "new-")))

    before = copies()
    for rows in (OLD, NEW):
        stage(spark, staged, rows)
        target.load(staged)
    assert copies() == before
    assert state(target, staged) == ([1, 2, 3], [7])


@pytest.mark.parametrize(
    ("policy", "expected"), [(load.KEEP_ALL, (6, 3, 2, 0, 1)), (load.KEEP_FIRST, (6, 2, 2, 1, 1))]
)
def test_counts_of_a_load(spark, tmp_path, policy, expected):
    staged, target = str(tmp_path / "in"), VersionedTarget(spark, str(tmp_path / "out"))
    stage(spark, staged, OLD)
    target.load(staged)
    twice = [NEW[0], NEW[0], NEW[1], NEW[1], (4, 1, "20240301", "A", 5), NEW[2]]
    stage(spark, staged, twice)
    assert tuple(target.load(staged, policy).first()) == expected


def test_files_deleted_by_another_load_while_they_are_read(spark, tmp_path, monkeypatch):
    staged, root = str(tmp_path / "in"), str(tmp_path / "out")
    one, other = VersionedTarget(spark, root), VersionedTarget(spark, root)
    stage(spark, staged, OLD)
    write = one.store.write

    def late(*args, **more):
        other.load(staged)
        return write(*args, **more)

    monkeypatch.setattr(one.store, "write", late)
    with pytest.raises(Conflict):
        one.load(staged)
    monkeypatch.undo()
    assert state(one, staged) == ([1, 2], [])
