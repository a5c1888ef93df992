"""Streams: byte-limited micro-batches, restarts in the middle, whole results for readers."""

import pytest
from pyspark.sql import functions as F

from tessera.streaming import commits, regression
from tessera.streaming.commits import commit_version, current_version, read_current
from tessera.streaming.regression import read_stream, start_regression


def points(folder, n=6, per=40):
    folder.mkdir()
    xs = []
    for i in range(n):
        rows = [(i * per + j, 3 * (i * per + j) + 1 + (j % 3)) for j in range(per)]
        xs += rows
        (folder / f"p{i}.txt").write_text("".join(f"{x} {y}\n" for x, y in rows) + "bad line\n7\n")
    return xs


def expected(xs):
    n, mx, my = len(xs), sum(x for x, _ in xs) / len(xs), sum(y for _, y in xs) / len(xs)
    beta = sum((x - mx) * (y - my) for x, y in xs) / sum((x - mx) ** 2 for x, _ in xs)
    return n, beta, my - beta * mx


def same(row, xs):
    n, beta, alpha = expected(xs)
    return row["n"] == n and row["beta"] == pytest.approx(beta) and row["alpha"] == pytest.approx(alpha)


def test_batches_are_limited_by_bytes(spark, tmp_path):
    xs = points(tmp_path / "in")
    q = start_regression(spark, read_stream(spark, "text", str(tmp_path / "in"), maxBytesPerTrigger=400),
                         checkpoint=str(tmp_path / "ck"), sink="table", table_path=str(tmp_path / "fit"))
    q.awaitTermination()
    assert current_version(spark, str(tmp_path / "fit"))["epoch"] >= 2  # several micro-batches
    assert same(read_current(spark, str(tmp_path / "fit")).first(), xs)


@pytest.mark.parametrize("when", ["before the commit", "after the commit"])
def test_restart_in_the_middle(spark, tmp_path, monkeypatch, when):
    xs, fit, log = points(tmp_path / "in"), str(tmp_path / "fit"), str(tmp_path / "ck")
    whole = regression.commit_version

    def dies(df, path, epoch, **entries):
        if epoch == 1 and when.startswith("before"):
            raise RuntimeError("lost driver")
        whole(df, path, epoch=epoch, **entries)
        if epoch == 1:
            raise RuntimeError("lost driver")

    start = lambda: start_regression(spark, read_stream(spark, "text", str(tmp_path / "in"), maxBytesPerTrigger=400),
                                     checkpoint=log, sink="table", table_path=fit)
    monkeypatch.setattr(regression, "commit_version", dies)
    with pytest.raises(Exception, match="lost driver"):
        start().awaitTermination()
    assert current_version(spark, fit)["epoch"] == (0 if when.startswith("before") else 1)
    assert 0 < read_current(spark, fit).first()["n"] < len(xs)
    monkeypatch.undo()
    start().awaitTermination()
    assert same(read_current(spark, fit).first(), xs)  # nothing twice, nothing lost


def test_reader_sees_whole_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_current(spark, path)
    commit_version(spark.range(5), path, epoch=0)
    open_reader = read_current(spark, path)
    commit_version(spark.range(7), path, epoch=1)
    assert open_reader.count() == 5  # the version before stays for those that have it

    def crash(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(commits, "_replace_file", crash)
    with pytest.raises(RuntimeError):
        commit_version(spark.range(100), path, epoch=2)
    monkeypatch.undo()
    assert read_current(spark, path).count() == 7
    for i in range(3):
        commit_version(spark.range(8 + i), path, epoch=3 + i)
    assert read_current(spark, path).count() == 10 and current_version(spark, path)["epoch"] == 5
    kept = [p.name for p in (tmp_path / "t" / "_versions").iterdir()]
    assert len(kept) == 3  # the current one, the one before, and the one that was never committed


def test_other_checkpoint_starts_anew(spark, tmp_path):
    fit = str(tmp_path / "fit")
    xs = points(tmp_path / "a", n=4)
    first = start_regression(spark, read_stream(spark, "text", str(tmp_path / "a"), maxBytesPerTrigger=1),
                             checkpoint=str(tmp_path / "ck1"), sink="table", table_path=fit)
    first.awaitTermination()
    assert current_version(spark, fit)["epoch"] == 3
    second = start_regression(spark, read_stream(spark, "text", str(tmp_path / "a")),
                              checkpoint=str(tmp_path / "ck2"), sink="table", table_path=fit)
    second.awaitTermination()
    assert current_version(spark, fit)["epoch"] == 0 and same(read_current(spark, fit).first(), xs)
    assert read_current(spark, fit).select(F.count("*")).first()[0] == 1
