"""Delimited uploads by many tasks against the reader with one task."""

import random

import pytest
from pyspark.sql import functions as F

from milepost.sources import uploads
from milepost.sources.tables import read_upload
from milepost.sources.uploads import read_upload_split


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    saved = spark.conf.get(key)

    def use(size):
        spark.conf.set(key, str(size))

    yield use
    spark.conf.set(key, saved)


def one_task(spark, path):
    """What the plain reader gives, its rows numbered."""
    df = read_upload(spark, path)
    return [(*r, i) for i, r in enumerate(df.collect())]


def many_tasks(spark, path):
    df = read_upload_split(spark, path, position="at")
    return [tuple(r) for r in df.orderBy("at").collect()]


def field(rng):
    kind = rng.random()
    if kind < 0.15:
        return ""
    if kind < 0.45:
        return f"v{rng.randrange(1000)}"
    if kind < 0.55:
        return '""'
    inside = "".join(rng.choice(["a", "ñ", "日", ",", "\n", "\n\n", '""', " ", "x,y"]) for _ in range(rng.randrange(1, 12)))
    return f'"{inside}"'


@pytest.mark.parametrize(("seed", "size", "end"), [(1, 40, "\n"), (2, 97, "\n"), (3, 300, "\n"), (4, 64, "\r\n"), (5, 1 << 20, "\n")])
def test_equals_the_one_task_reader(spark, tmp_path, small_splits, seed, size, end):
    rng = random.Random(seed)
    lines = ["Reserva,SKU,Motivo"]
    for i in range(120):
        lines.append(",".join([f"r{i}", field(rng), field(rng)]))
        if rng.random() < 0.1:
            lines.append("")
    path = tmp_path / "u.csv"
    path.write_bytes((end.join(lines) + (end if seed % 2 else "")).encode())
    expected = one_task(spark, str(path))
    small_splits(size)
    df = read_upload_split(spark, str(path), position="at")
    assert df.columns == ["Reserva", "SKU", "Motivo", "at"]
    if size < 100:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 20
    assert many_tasks(spark, str(path)) == expected and len(expected) == 120


def test_a_record_over_many_splits_and_a_header_with_a_line_end(spark, tmp_path, small_splits):
    path = tmp_path / "u.csv"
    path.write_text('"a\nb",c\n1,"' + "long\n" * 100 + '"\n2,x\n\n3,"y ""q"" z"\n')
    expected = one_task(spark, str(path))
    small_splits(32)
    assert many_tasks(spark, str(path)) == expected
    assert [r[-1] for r in expected] == [0, 1, 2] and read_upload_split(spark, str(path)).columns == ["a\nb", "c"]


def test_short_and_long_records_and_repeated_names(spark, tmp_path, small_splits):
    path = tmp_path / "u.csv"
    path.write_text("a,a,at\n1\n1,2,3,4\n,,\n1,2,3\n1,2,3\n")
    plain = read_upload(spark, str(path))
    small_splits(8)
    out = read_upload_split(spark, str(path), position="position")
    assert out.columns == [*plain.columns, "position"]
    assert [tuple(r)[:-1] for r in out.orderBy("position").collect()] == [tuple(r) for r in plain.collect()]


def test_folder_in_order_of_paths(spark, tmp_path, small_splits):
    for i, name in enumerate(["b.csv", "a.csv", "c.csv"]):
        (tmp_path / name).write_text("k,v\n" + "".join(f'{name}{j},"x\n{j}"\n' for j in range(20 * i)))
    small_splits(50)
    got = many_tasks(spark, str(tmp_path))
    want = [(f"{n}{j}", f"x\n{j}") for n, rows in (("a.csv", 20), ("c.csv", 40)) for j in range(rows)]
    assert got == [(*r, i) for i, r in enumerate(want)]


def test_header_alone_and_unclosed_quote(spark, tmp_path, small_splits):
    (tmp_path / "h.csv").write_text("k,v\n")
    out = read_upload_split(spark, str(tmp_path / "h.csv"), position="at")
    assert out.columns == ["k", "v", "at"] and out.count() == 0
    (tmp_path / "q.csv").write_text('k,v\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="unclosed quote"):
        read_upload_split(spark, str(tmp_path / "q.csv"), position="at").collect()


def test_whole_records_are_not_grouped(spark, tmp_path):
    """Lines that are a record by themselves are moved once, for their order in the split."""
    (tmp_path / "p.csv").write_text("k,v\n1,x\n")
    plan = read_upload_split(spark, str(tmp_path / "p.csv")).select(F.col("k"))._jdf.queryExecution().optimizedPlan().toString()
    direct = plan[plan.index("Union") :].split("Aggregate [position")[0]
    assert "collect_list" not in direct


def test_lines_are_joined_where_they_are_read(spark, tmp_path):
    """Only records over the end of a batch are moved; lines aren't sorted or shuffled for their order."""
    path = tmp_path / "j.csv"
    path.write_text("k,v\n" + "".join(f'{i},"a\n""{i}""\n\n"\n\n' for i in range(100)))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    saved, expected = spark.conf.get(key), one_task(spark, str(path))
    lines = uploads._lines(spark, str(path))
    parts = uploads._parts(lines.join(F.broadcast(uploads._splits(lines)), uploads.SPLIT))
    assert parts.where("whole").count() == 100 and parts.where("NOT whole").count() == 0
    try:
        for size in (1, 3, 7):
            spark.conf.set(key, size)
            assert many_tasks(spark, str(path)) == expected
    finally:
        spark.conf.set(key, saved)
    plan = read_upload_split(spark, str(path), position="at")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
