"""Scratch folders that are recorded can be deleted, but for those still read."""

from pathlib import Path

from milepost.session import discard, recorded, written


def test_discard_keeps_what_is_read(spark):
    paths: list[str] = []
    with recorded(paths):
        a, b = (written(spark.range(n), "scratch-test") for n in (3, 4))
    other = written(spark.range(5), "scratch-test")
    assert len(paths) == 2
    kept = paths[1]
    discard(spark, paths, unless_read_by=[b.filter("id > 1")])
    assert paths == [kept] and b.count() == 4 and other.count() == 5
    discard(spark, paths)
    assert paths == [] and not Path(kept.removeprefix("file:")).exists()
