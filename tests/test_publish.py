"""Publishing: versions with one commit, folder swaps, and failures between any two steps."""

import json
import os
import threading

import pytest
from conftest import SF_SMALL

from erpweave.plans import harmonize, harmonize_data, read_published
from erpweave.plans.catalog import AS_OF
from erpweave.sources import sinks, versions
from erpweave.sources.fixtures import TpchErpSources


class _Few(TpchErpSources):
    """Only a part of every table that has the given column: another day's extract."""

    def __init__(self, sf_dir, rest):
        super().__init__(sf_dir)
        self.rest = rest

    def load(self, spark, system, table):
        df = super().load(spark, system, table)
        key = {"MARC": "MATNR", "AFKO": "AUFNR"}.get(table)
        return df.filter(f"crc32({key}) % 7 != {self.rest}") if key else df


def _run(spark, root, rest, **options):
    return harmonize_data(
        spark, _Few(SF_SMALL, rest), root, order_options={"as_of": AS_OF}, **{"on_key_violation": "report", **options}
    )


def _seen(spark, root):
    return {n: read_published(spark, root, n).count() for n in ("local_material", "process_order")}


def _rows(results):
    return {n: r.rows for n, r in results.items()}


def test_versions_replace_each_other_by_one_commit(spark, tmp_path):
    root = str(tmp_path / "out")
    first = _run(spark, root, 0, versioned=True)
    assert _seen(spark, root) == _rows(first)
    second = _run(spark, root, 1, versioned=True)
    assert _rows(first) != _rows(second) and _seen(spark, root) == _rows(second)
    assert versions.history(spark, root) == [1, 2]
    for name, result in first.items():  # the older commit stays readable
        assert read_published(spark, root, name, commit=1).count() == result.rows
    assert versions.vacuum(spark, root, keep=1) == sorted(r.path for r in first.values())
    assert _seen(spark, root) == _rows(second)


@pytest.mark.parametrize("step", ["write local_material", "write process_order", "check", "commit"])
def test_a_failure_at_any_step_leaves_both_old_versions(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "out")
    old = _rows(_run(spark, root, 0, versioned=True))
    before = sorted(str(p) for p in (tmp_path / "out").rglob("*.parquet"))

    def stop(*args, **kwargs):
        raise OSError("stopped here")

    with monkeypatch.context() as m:
        if step.startswith("write"):
            write, name = harmonize.write_table, step.split()[1]
            m.setattr(harmonize, "write_table", lambda df, path, **k: stop() if f"/{name}/" in path else write(df, path, **k))
        elif step == "check":
            m.setattr(harmonize, "_check", stop)
        else:
            m.setattr(versions, "_create", stop)
        with pytest.raises(OSError, match="stopped here"):
            _run(spark, root, 1, versioned=True)
    assert _seen(spark, root) == old
    assert sorted(str(p) for p in (tmp_path / "out").rglob("*.parquet")) == before


def test_a_killed_commit_does_not_count(spark, tmp_path):
    """A commit file that was not written to its end is passed over, and its number stays taken."""
    root = str(tmp_path / "out")
    old = _rows(_run(spark, root, 0, versioned=True))
    whole = (tmp_path / "out/commits/000000000001.json").read_text()
    (tmp_path / "out/commits/000000000002.json").write_text(whole[: len(whole) // 2])
    assert _seen(spark, root) == old and versions.history(spark, root) == [1]
    new = _rows(_run(spark, root, 1, versioned=True))
    assert _seen(spark, root) == new and versions.history(spark, root) == [1, 3]


def test_raise_mode_publishes_nothing_on_a_duplicate(spark, tmp_path):
    root = str(tmp_path / "out")
    old = _rows(_run(spark, root, 0, versioned=True))
    with pytest.raises(ValueError, match="is not unique"):
        _run(spark, root, 1, versioned=True, on_key_violation="raise")
    assert _seen(spark, root) == old and versions.history(spark, root) == [1]


def test_the_slower_of_two_runs_is_refused(spark, tmp_path):
    root = str(tmp_path / "out")
    entry = {"a": versions.Version("a", f"{root}/versions/a/r", "parquet", 1, "r")}
    assert versions.commit(spark, root, entry, 0) == 1
    with pytest.raises(versions.ConcurrentCommit):
        versions.commit(spark, root, entry, 0)
    other = {"b": versions.Version("b", f"{root}/versions/b/s", "parquet", 2, "s")}
    versions.commit(spark, root, other, 1)
    assert set(versions.versions(spark, root)) == {"a", "b"}  # a stays current
    content = json.loads((tmp_path / "out/commits/000000000002.json").read_text())
    assert content["data_sets"]["a"]["path"] == "versions/a/r"  # the root can be moved
    taken = []

    def take():
        try:
            taken.append(versions.commit(spark, root, other, 2))
        except versions.ConcurrentCommit:
            taken.append(None)

    threads = [threading.Thread(target=take) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert [n for n in taken if n] == [3]


def test_roots_without_commits(spark, tmp_path):
    assert versions.versions(spark, str(tmp_path)) == {} and versions.history(spark, str(tmp_path)) == []
    with pytest.raises(Exception, match="does not exist|not found"):
        versions.versions(spark, str(tmp_path), commit=4)


# ---------------------------------------------------------------- plain folders


def _folder(path, text):
    path.mkdir(parents=True)
    (path / "part").write_text(text)
    return str(path)


@pytest.mark.parametrize("fails", [1, 2, 3, 4])
def test_a_failed_rename_puts_all_folders_back(spark, tmp_path, monkeypatch, fails):
    staged = {_folder(tmp_path / f"new_{n}", f"new {n}"): _folder(tmp_path / n, f"old {n}") for n in "ab"}
    rename, calls = sinks._rename, []

    def failing(fs, source, target):
        calls.append(source)
        if len(calls) == fails:
            raise OSError("rename refused")
        rename(fs, source, target)

    monkeypatch.setattr(sinks, "_rename", failing)
    with pytest.raises(OSError, match="rename refused"):
        sinks.swap_folders(spark, staged)
    assert {n: (tmp_path / n / "part").read_text() for n in "ab"} == {"a": "old a", "b": "old b"}
    assert sorted(os.listdir(tmp_path)) == ["a", "b", "new_a", "new_b"]


def test_swap_replaces_and_creates(spark, tmp_path):
    staged = {
        _folder(tmp_path / "new_a", "new a"): _folder(tmp_path / "a", "old a"),
        _folder(tmp_path / "new_b", "new b"): str(tmp_path / "b"),
    }
    sinks.swap_folders(spark, staged)
    assert sorted(os.listdir(tmp_path)) == ["a", "b"]
    assert [(tmp_path / n / "part").read_text() for n in "ab"] == ["new a", "new b"]


def test_report_mode_does_not_write_over_the_published_folder(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    old = _rows(_run(spark, root, 0))
    monkeypatch.setattr(harmonize, "_check", lambda *a: (_ for _ in ()).throw(OSError("stopped here")))
    with pytest.raises(OSError, match="stopped here"):
        _run(spark, root, 1)
    assert _seen(spark, root) == old
    assert sorted(os.listdir(root)) == ["local_material", "process_order"]


def test_data_sets_are_written_one_after_the_other(spark, tmp_path, monkeypatch):
    """No write begins while another one, with its shuffle files, is under way; the results keep their order."""
    seen, write = [], harmonize._write

    def noted(df, name, *args, **target):
        seen.append(("begins", name))
        out = write(df, name, *args, **target)
        seen.append(("ends", name))
        return out

    monkeypatch.setattr(harmonize, "_write", noted)
    results = _run(spark, str(tmp_path / "out"), 0)
    assert seen == [(step, name) for name in ("process_order", "local_material") for step in ("begins", "ends")]
    assert list(results) == ["local_material", "process_order"]
    assert _seen(spark, str(tmp_path / "out")) == _rows(results)
