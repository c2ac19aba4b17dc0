"""Text readers: nothing is dropped, shifted or guessed."""

import pytest
from pyspark.sql import functions as F

from yieldloom.sources.text import numbered_lines, read_labels, read_measurements


def written(tmp_path, text):
    (tmp_path / "input.data").write_text(text)
    return str(tmp_path)


def test_white_space_around_lines_moves_no_cell(spark, tmp_path):
    rows = read_measurements(spark, written(tmp_path, "\t\n1 2 3\n\t4 5\t6\n \t \n7  NaN 9 \t\n")).orderBy("entity_id").collect()
    assert [tuple(r) for r in rows] == [(1, 1.0, 2.0, 3.0), (2, 4.0, 5.0, 6.0), (3, 7.0, None, 9.0)]


@pytest.mark.parametrize("text", ["1 2\n4 5 6\n", "1 2 3\n4 5\n"])
def test_lines_of_another_width_are_refused(spark, tmp_path, text):
    with pytest.raises(ValueError, match="from 2 to 3 cells"):
        read_measurements(spark, written(tmp_path, text))


def test_bad_cells_are_counted(spark, tmp_path):
    path = written(tmp_path, "1 x3\nN/A 5,0\n")
    with pytest.raises(ValueError, match="2 cells"):
        read_measurements(spark, path)
    assert [tuple(r) for r in read_measurements(spark, path, most_bad_cells=2).orderBy("entity_id").collect()] == [(1, 1.0, None), (2, None, None)]


def test_no_measurements(spark, tmp_path):
    with pytest.raises(ValueError, match="no measurements"):
        read_measurements(spark, written(tmp_path, "\t\n\n"))


def test_labels_with_tabs(spark, tmp_path):
    rows = read_labels(spark, written(tmp_path, '\t-1 "19/07/2008 11:55:00"\n1\t20/07/2008 01:02:03\t\n')).orderBy("entity_id")
    shown = rows.select("yield_label", "pass_fail", F.date_format("test_timestamp", "yyyy-MM-dd HH:mm:ss")).collect()
    assert [tuple(r) for r in shown] == [(-1, "pass", "2008-07-19 11:55:00"), (1, "fail", "2008-07-20 01:02:03")]


@pytest.mark.parametrize("line", ['x "19/07/2008 11:55:00"', '-1 "19/07/2008 99:32:00"', "-1"])
def test_bad_labels_are_refused(spark, tmp_path, line):
    path = written(tmp_path, f'1 "19/07/2008 11:55:00"\n{line}\n')
    with pytest.raises(ValueError, match="1 lines"):
        read_labels(spark, path)
    kept = {r.entity_id: r for r in read_labels(spark, path, most_bad_lines=1).collect()}
    assert kept[1].pass_fail == "fail" and (kept[2].yield_label is None) == (kept[2].pass_fail is None)


def test_numbers_follow_the_files(spark, tmp_path):
    for name, count in (("a", 3), ("b", 2)):
        (tmp_path / name).write_text("".join(f"{name}{i}\n\t\n" for i in range(count)))
    assert [r.value for r in numbered_lines(spark, str(tmp_path)).orderBy("row_number").collect()] == ["a0", "a1", "a2", "b0", "b1"]


def test_numbers_hold_when_files_are_split_otherwise_later(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(2000)]
    (tmp_path / "one").write_text("\n".join(lines[:1500]))
    (tmp_path / "two").write_text("\n".join(lines[1500:]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        numbered = numbered_lines(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1777")
        got = sorted((r.row_number, r.value) for r in numbered.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i + 1, line.strip()) for i, line in enumerate(lines)]


def test_numbered_document_lines_writes_more_files_for_a_larger_table(spark, tmp_path, monkeypatch):
    from yieldloom.plans.queries import sources
    from yieldloom.plans.registry import QUERIES

    rows = [(i, f"line {i}\n\nmore {i}") for i in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(9).write.parquet(f"{tmp_path}/documents.parquet")
    files = []

    def counted(session, folder):
        files.append(len(session.read.text(folder).inputFiles()))
        return numbered_lines(session, folder)

    monkeypatch.setattr(sources, "numbered_lines", counted)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    # a split for each of the nine files
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        row = QUERIES["numbered_document_lines"](spark, str(tmp_path)).head()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (row.n_lines, row.first_number, row.last_number, row.n_numbers) == (180, 1, 180, 180)
    assert files[0] > 4
