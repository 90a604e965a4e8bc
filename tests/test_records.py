"""Quoted line breaks over split bounds, against Spark's one-task reader."""

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daygrid.sources import readers as R
from daygrid.sources import records as Q

CELL = st.text(alphabet='ab "\n,;é', max_size=9)
TABLE = st.integers(1, 3).flatmap(lambda n: st.lists(st.lists(CELL, min_size=n, max_size=n), max_size=12))


def written(path, rows, encoding="utf-8", end="\n"):
    text = io.StringIO(newline="")
    csv.writer(text, quoting=csv.QUOTE_ALL, lineterminator=end).writerows(rows)
    path.write_bytes(text.getvalue().encode(encoding))


def values(df):
    return sorted(tuple("" if v is None else v for v in r) for r in df.collect())


@pytest.fixture()
def tiny_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(TABLE)
def test_any_table_over_many_splits(spark, tiny_splits, tmp_path_factory, rows):
    folder = tmp_path_factory.mktemp("csv")
    n = len(rows[0]) if rows else 1
    written(folder / "t.csv", [[f"h{i}" for i in range(n)], *rows])
    got = Q.read_records(spark, str(folder / "t.csv"), ",", "UTF-8")
    assert got.columns == [f"h{i}" for i in range(n)]
    assert values(got) == sorted(map(tuple, rows))


def test_equal_to_the_one_task_reader(spark, tiny_splits, tmp_path):
    rows = [["a", "b"], ["1", "x\ny"], ["2", 'say "hi"\n\n"bye"'], ["3", ""], ["4", "long " * 30 + "\n" * 40 + "end"], ["5", "plain"]]
    for encoding, end in (("utf-8", "\n"), ("utf-8", "\r\n"), ("latin-1", "\n")):
        p = tmp_path / f"{encoding}{len(end)}.csv"
        written(p, [*rows, ["6", "é"]], encoding, end)
        spec = {"utf-8": "UTF-8", "latin-1": "ISO-8859-1"}[encoding]
        split = Q.read_records(spark, str(p), ",", spec)
        one = spark.read.csv(str(p), header=True, multiLine=True, escape='"', encoding=spec)
        assert split.columns == one.columns and values(split) == values(one) and len(values(one)) == 6
        assert Q._text_lines(spark, str(p)).rdd.getNumPartitions() > 10


def test_many_files_loose_quotes_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x;y;\n\n1;5" pipe;"q"\n2;"a ""b""\n;c";z\n\r\n')
    (tmp_path / "b.csv").write_text('x;y;\n3;"no end\n')
    got = R.read_csv(spark, str(tmp_path), ";", "UTF-8", multi_line=True)
    assert got.columns == ["x", "y", "_c2"]
    rows = {r["x"]: r for r in got.collect()}
    assert set(rows) == {"1", "2", "3"} and rows["1"]["y"] == '5" pipe' and rows["2"]["y"] == 'a "b"\n;c' and rows["2"]["_c2"] == "z"


def test_state_of_a_line():
    assert [Q.ends_inside(b'a,"b', s, b",") for s in (False, True)] == [True, False]
    assert [Q.ends_inside(b'a","b"', s, b",") for s in (False, True)] == [False, False]
    assert Q.ends_inside(b'"a""', False, b",") and not Q.ends_inside(b'5",6', False, b",")
    assert not Q.ends_inside(b"plain", False, b",") and Q.ends_inside(b"plain", True, b",")
