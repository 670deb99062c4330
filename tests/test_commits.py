"""Sets of tables that become visible together."""

import pytest

from layerloom.sources.commits import CommitConflict, CommitLog, TableEntry
from layerloom.sources.layers import version_order, write_version


def entry(spark, root, table, run_id, n):
    path = f"{root}/{table}"
    return TableEntry.of(write_version(spark.range(n), path, run_id), f"{path}/version={run_id}", highest=n)


def test_readers_see_whole_sets(spark, tmp_path):
    root = str(tmp_path)
    log = CommitLog(spark, root)
    assert log.read() is None and log.sequences() == [] and log.before("x") == (None, 0)
    first = log.put("run-9", {t: entry(spark, root, t, "run-9", 3) for t in ("a", "b")}, after=0)
    held = CommitLog(spark, root).read()
    entry(spark, root, "a", "run-10", 7)  # loaded, but not committed yet
    assert {n: df.count() for n, df in held.read(spark).items()} == {"a": 3, "b": 3} and held == first
    second = log.put("run-10", {t: entry(spark, root, t, "run-10", 7) for t in ("a", "b")}, after=1)
    assert {n: df.count() for n, df in log.read().read(spark).items()} == {"a": 7, "b": 7}
    assert {n: df.count() for n, df in log.read(1).read(spark).items()} == {"a": 3, "b": 3}
    assert second.tables["a"].facts == {"highest": 7} and log.sequences() == [1, 2]
    with pytest.raises(FileNotFoundError, match="no commit 5"):
        log.read(5)


def test_the_second_of_two_writers_is_told(spark, tmp_path):
    one, two = CommitLog(spark, str(tmp_path)), CommitLog(spark, str(tmp_path))
    one.put("a", {}, after=0)
    with pytest.raises(CommitConflict):
        two.put("b", {}, after=0)
    # both looked before either wrote: the name is taken when the second renames
    two.sequences = lambda: []
    with pytest.raises(CommitConflict, match="meanwhile"):
        two.put("b", {}, after=0)
    assert [one.read(n).run_id for n in one.sequences()] == ["a"]
    assert not [p.name for p in (tmp_path / "_commits").iterdir() if p.name.endswith(".tmp")]


def test_a_repeated_run_starts_where_it_did(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    for run_id in ("a", "b", "b"):
        log.put(run_id, {})
    assert log.before("b")[0].sequence == 1 and log.before("b")[1] == 2
    assert log.before("c")[0].sequence == 3 and log.before("a") == (None, 1)


def test_retention_deletes_only_what_no_kept_commit_names(spark, tmp_path):
    root = str(tmp_path)
    log = CommitLog(spark, root)
    shared = entry(spark, root, "dim", "1", 2)
    for run_id in ("1", "2", "3"):
        log.put(run_id, {"dim": shared, "fact": entry(spark, root, "fact", run_id, 4)})
    assert log.expire(2) == [f"{root}/fact/version=1"]
    assert log.sequences() == [2, 3] and not (tmp_path / "fact" / "version=1").exists()
    assert {n: df.count() for n, df in log.read(2).read(spark).items()} == {"dim": 2, "fact": 4}
    assert log.put("4", {}).sequence == 4
    with pytest.raises(ValueError):
        log.expire(0)


def test_versions_are_ordered_by_their_numbers():
    assert sorted(["run-10", "run-9", "run-9-2", "2024"], key=version_order) == ["run-9", "run-9-2", "run-10", "2024"]
