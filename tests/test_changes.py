"""Versioned tables, MERGE, UPDATE, DELETE and views on rows written by hand."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.sources import changes, loader, storage, views
from tidemark.sources.changes import DELETE, INSERT, UPDATE, Clause, KeyViolation
from tidemark.sources.storage import CommitConflict, commit, current_version, live_files, read_table, read_version

def frame(spark, data):
    rows = spark.createDataFrame(data, "id int, g string, v int")
    return rows.withColumn("v", F.col("v").cast("decimal(10,2)"))


def table(spark, dest, rows, schema=None, files=1, keys=("id",)):
    df = spark.createDataFrame(rows, schema) if schema else frame(spark, rows)
    df = df.repartitionByRange(files, keys[0]) if files > 1 else df.coalesce(1)
    changes.create_table(spark, dest, df, list(keys))
    return dest


def rows(spark, dest, **options):
    return sorted((tuple(r) for r in read_table(spark, dest, **options).collect()), key=repr)


@pytest.fixture
def dest(tmp_path):
    return str(tmp_path / "t")


def test_one_writer_makes_a_version(spark, dest):
    base = current_version(spark, dest)
    assert base.number == 0 and commit(spark, dest, base, ["load-a"]).number == 1
    with pytest.raises(CommitConflict):
        commit(spark, dest, base, ["load-b"])
    assert current_version(spark, dest).loads == ("load-a",)


def test_many_appends_at_once_all_stay(spark, dest):
    table(spark, dest, [], "id int", keys=("id",))
    run = lambda i: changes.append_rows(spark, dest, spark.range(i, i + 1).select(F.col("id").cast("int")))
    threads = [threading.Thread(target=run, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert rows(spark, dest) == [(i,) for i in range(8)] and current_version(spark, dest).number == 9


def load(spark, tmp_path, name, ids, dest, mode="append"):
    path = tmp_path / f"{name}.csv"
    path.write_text("id\n" + "\n".join(map(str, ids)) + "\n")
    return loader.load_table(spark, str(path), spark.range(0).schema, dest, mode)


@pytest.mark.parametrize("other, kept", [([5, 6], [1, 2, 5, 6, 7]), ([7], [1, 2, 7])])
def test_a_load_meets_another_one(spark, tmp_path, dest, monkeypatch, other, kept):
    """Between the check of a load and its commit another load gets in: it stays, and so does the first unless keys repeat."""
    load(spark, tmp_path, "first", [1, 2], dest)
    real, met = loader.commit, []

    def late(*args, **more):
        if not met:
            met.append(load(spark, tmp_path, "other", other, dest) if met.append(0) is None else 0)
        return real(*args, **more)

    monkeypatch.setattr(loader, "commit", late)
    if 7 in other:
        with pytest.raises(KeyViolation, match="id=7 is already"):
            load(spark, tmp_path, "late", [7], dest)
    else:
        load(spark, tmp_path, "late", [7], dest)
    assert [i for (i,) in rows(spark, dest)] == kept


def test_merge_touches_only_files_with_a_changed_row(spark, dest):
    table(spark, dest, [(i, "a", i) for i in range(1000)], files=10)
    before = live_files(spark, dest, current_version(spark, dest))
    source = frame(spark, [(5, "b", 1), (7, "b", 2), (950, "b", 3), (2000, "new", 4)])
    done = changes.merge(spark, dest, source, ["id"])
    assert done[:5] == (3, 0, 1, 2, 8)
    after = live_files(spark, dest, current_version(spark, dest))
    assert len(set(before) & set(after)) == 8
    assert len(changes._candidates(spark, dest, current_version(spark, dest), source, 4, "id")) < 10  # ranges stay narrow
    many = frame(spark, [(i, "c", 0) for i in range(3000, 4000)])
    assert len(changes._candidates(spark, dest, current_version(spark, dest), many, 1000, "id")) < 3
    found = dict((r[0], r[1:]) for r in rows(spark, dest))
    assert len(found) == 1001 and found[5][0] == "b" and found[6][0] == "a" and found[2000][0] == "new"
    assert len(rows(spark, dest, version=read_version(spark, dest, 1))) == 1000  # the older version is still there
    assert changes.merge(spark, dest, source.where("id = 2000"), ["id"], matched=(Clause("delete", F.col("t.g") == "zzz"),)).version == done.version


def test_merge_against_a_plain_loop(spark, dest):
    rng = random.Random(4)
    have = {(i, j): (rng.choice("ab"), rng.randrange(50)) for i in range(30) for j in "xy" if rng.random() < 0.8}
    table(spark, dest, [(*k, *v) for k, v in have.items()], "id int, k string, g string, v int", 4, ("id", "k"))
    for _ in range(3):
        source = {(rng.randrange(40), rng.choice("xyz")): rng.randrange(50) for _ in range(25)}
        df = spark.createDataFrame([(*k, v) for k, v in source.items()], "id long, k string, w int")
        changes.merge(
            spark, dest, df, ["id", "k"],
            matched=(Clause("delete", F.col("s.w") < 10), Clause("update", F.col("t.g") == "a", {"v": F.col("t.v") + F.col("s.w")})),
            unmatched=(Clause("insert", F.col("s.w") > 20, {"id": F.col("s.id"), "k": F.col("s.k"), "v": F.col("s.w")}),),
        )
        for k, w in source.items():
            if k in have:
                g, v = have[k]
                if w < 10:
                    del have[k]
                elif g == "a":
                    have[k] = (g, v + w)
            elif w > 20:
                have[k] = (None, w)
        assert rows(spark, dest) == sorted(((*k, *v) for k, v in have.items()), key=repr)


def test_merge_edges(spark, dest):
    changes.create_table(spark, dest, frame(spark, [(1, "a", 1), (None, "n", 2), (3, "c", 3), (3, "d", 4)]).coalesce(1))
    for bad in ([(1, "x", 1), (1, "y", 2)], [(None, "x", 1)]):
        with pytest.raises(KeyViolation):
            changes.merge(spark, dest, frame(spark, bad), ["id"])
    version = current_version(spark, dest).number
    assert changes.merge(spark, dest, frame(spark, []), ["id"]) == (0, 0, 0, 0, 1, version)
    assert changes.merge(spark, dest, frame(spark, [(3, "z", 9)]), ["id"])[:3] == (2, 0, 0)  # both rows of a repeated key
    assert [r[1] for r in rows(spark, dest)] == ["a", "z", "z", "n"]
    with pytest.raises(ValueError, match="no columns"):
        changes.merge(spark, dest, frame(spark, [(1, "a", 1)]), ["id"], matched=(Clause("update", None, {"zz": F.lit(1)}),))
    with pytest.raises(Exception, match="(?i)overflow|out of range|CAST|cannot"):
        changes.merge(spark, dest, spark.createDataFrame([(10**12, "a", 1)], "id long, g string, v int"), ["id"])
    with pytest.raises(FileNotFoundError):
        changes.merge(spark, dest + "none", frame(spark, [(1, "a", 1)]), ["id"])
    assert len(rows(spark, dest)) == 4
    assert changes.merge(spark, dest, frame(spark, [(1, "a", 1), (3, "a", 1), (4, "q", 1)]), ["id"], (DELETE,), ())[:3] == (0, 3, 0)
    assert [r[1] for r in rows(spark, dest)] == ["n"]


def test_all_rows_go_and_others_come(spark, dest):
    table(spark, dest, [(i, "a", i) for i in range(10)], files=3)
    assert changes.delete(spark, dest, None)[:3] == (0, 10, 0)
    assert rows(spark, dest) == [] and live_files(spark, dest, current_version(spark, dest)) == []
    assert read_table(spark, dest).schema.simpleString() == "struct<id:int,g:string,v:decimal(10,2)>"
    assert changes.update(spark, dest, None, {"g": F.lit("x")}).updated == 0
    assert changes.merge(spark, dest, frame(spark, [(1, "b", 5)]), ["id"], (UPDATE,), (INSERT,)).inserted == 1
    assert len(rows(spark, dest)) == 1 and storage.clear_leftovers(spark, dest) == 1 and len(rows(spark, dest)) == 1


def test_update_and_delete_skip_unknown_conditions(spark, dest):
    changes.create_table(spark, dest, frame(spark, [(1, None, 1), (2, "a", 2), (3, "b", 3)]))
    assert changes.update(spark, dest, F.col("g") != "b", {"v": F.col("v") + 10, "g": F.upper("g")}).updated == 1
    assert changes.delete(spark, dest, F.col("g") != "b").deleted == 1
    assert [r[0] for r in rows(spark, dest)] == [1, 3]
    with pytest.raises(ValueError):
        changes.update(spark, dest, None, {"zz": F.lit(1)})


def test_a_change_starts_again_on_a_newer_version(spark, dest, monkeypatch):
    table(spark, dest, [(i, "a", 1) for i in range(10)])
    real, met = changes.commit, []

    def late(*args, **more):
        if not met:
            met.append(1)
            changes.append_rows(spark, dest, frame(spark, [(50, "a", 1)]))
        return real(*args, **more)

    monkeypatch.setattr(changes, "commit", late)
    assert changes.update(spark, dest, F.col("g") == "a", {"v": F.lit(2)}).updated == 11
    assert {str(r[2]) for r in rows(spark, dest)} == {"2.00"}


# --- views -------------------------------------------------------------------

VIEW = views.View({"g": "g"}, {"total": "v"}, {"low": "v"}, {"high": "v", "last": "id"})


def recomputed(spark, dest):
    found = {}
    for i, g, v in rows(spark, dest):
        found.setdefault(g, []).append((i, v))
    out = []
    for g, pairs in found.items():
        vs = [v for _, v in pairs if v is not None]
        out.append((g, len(pairs), sum(vs) if vs else None, len(vs), min(vs, default=None), max(vs, default=None), max((i for i, _ in pairs if i is not None), default=None)))
    return sorted(out, key=repr)


def shown(spark, dest):
    found = views.read_view(spark, dest).select("g", "n_rows", "total", "n_total", "low", "high", "last").collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_view_follows_random_changes(spark, tmp_path):
    rng = random.Random(8)
    base, view = str(tmp_path / "b"), str(tmp_path / "v")
    new = lambda lo, n: frame(
        spark, [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, rng.randrange(100)])) for i in range(lo, lo + n)])
    changes.create_table(spark, base, new(0, 40).repartitionByRange(4, "id"), ["id"])
    for step in range(4):
        if step == 1:
            changes.append_rows(spark, base, new(100, 20))
        elif step == 2:
            changes.merge(spark, base, new(30, 90), ["id"])
        elif step == 3:
            changes.delete(spark, base, (F.col("g") == "a") | (F.col("v") > 60))
        views.refresh(spark, view, base, VIEW)
        assert shown(spark, view) == recomputed(spark, base), step
    changes.delete(spark, base, None)
    views.refresh(spark, view, base, VIEW)
    assert shown(spark, view) == []


def test_refresh_reads_only_what_changed(spark, tmp_path, monkeypatch):
    base, view = str(tmp_path / "b"), str(tmp_path / "v")
    simple = views.View({"g": "g"}, {"total": "v"})
    for i in range(5):
        changes.append_rows(spark, base, frame(spark, [(i, "a", 1), (i + 10, f"g{i}", 2)]).coalesce(1))
        read, real = [], views.read_files
        monkeypatch.setattr(views, "read_files", lambda s, d, files, schema: (read.extend(files), real(s, d, files, schema))[1])
        done = views.refresh(spark, view, base, simple)
        monkeypatch.setattr(views, "read_files", real)
        assert (done.files_added, done.files_removed) == (1, 0) and len(read) == (1 if i else 0)
    assert views.refresh(spark, view, base, simple) == (5, 0, 0, 0, 0)
    assert {r["g"]: (r["n_rows"], int(r["total"])) for r in views.read_view(spark, view).collect()}["a"] == (5, 5)


def test_two_refreshes_count_a_change_once(spark, tmp_path, monkeypatch):
    base, view = str(tmp_path / "b"), str(tmp_path / "v")
    simple = views.View({"g": "g"}, {"total": "v"})
    changes.append_rows(spark, base, frame(spark, [(1, "a", 1)]))
    views.refresh(spark, view, base, simple)
    changes.append_rows(spark, base, frame(spark, [(2, "a", 5)]))
    real, met = changes.commit, []

    def late(*args, **more):
        if not met:
            met.append(1)
            views.refresh(spark, view, base, simple)
        return real(*args, **more)

    monkeypatch.setattr(changes, "commit", late)
    views.refresh(spark, view, base, simple)
    assert [(r["n_rows"], int(r["total"])) for r in views.read_view(spark, view).collect()] == [(2, 6)]


def test_view_is_built_anew_when_old_files_are_cleared(spark, tmp_path):
    base, view = str(tmp_path / "b"), str(tmp_path / "v")
    changes.create_table(spark, base, frame(spark, [(i, "a", i) for i in range(9)]), ["id"])
    views.refresh(spark, view, base, VIEW)
    changes.delete(spark, base, F.col("id") < 3)
    storage.clear_leftovers(spark, base)
    views.refresh(spark, view, base, VIEW)
    assert shown(spark, view) == recomputed(spark, base)
    with pytest.raises(TypeError, match="exact"):
        views.refresh(spark, str(tmp_path / "w"), base, views.View({"g": "g"}, {"x": "CAST(v AS double)"}))
