"""Text and JSON sources, routing, the TSV sink and its write modes."""

import pytest
from conftest import rows

from quern.sources import read_json, read_lines, route_by_suffix, write_tsv


def test_read_lines_breaks_and_order(spark, tmp_path):
    p = tmp_path / "t.txt"
    p.write_bytes(b"a b\r\nc\rd\n\ne")
    df = read_lines(spark, str(p), with_order=True)
    got = [r.value for r in df.orderBy("line_order").collect()]
    assert got == ["a b", "c", "d", "", "e"]


def test_route_by_suffix(spark, tmp_path):
    (tmp_path / "left_table.txt").write_text("l1\nl2\n")
    (tmp_path / "x_right_table.txt").write_text("r1\n")
    (tmp_path / "join_key.txt").write_text("k\n")
    mixed = read_lines(spark, str(tmp_path / "*.txt"), with_source=True)
    assert rows(route_by_suffix(mixed, "left_table.txt")) == [("l1",), ("l2",)]
    assert rows(route_by_suffix(mixed, "right_table.txt")) == [("r1",)]


def test_write_tsv_null_group_and_modes(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", "x", "y"), ("2", "b", None, None)],
                               "k string, v string, r1 string, r2 string")
    out = str(tmp_path / "out")
    write_tsv(df, out, ["k", "v"], null_groups=[("r1", ["r1", "r2"])])
    text = sorted(r.value for r in spark.read.text(out).collect())
    assert text == ["1\ta\tx\ty", "2\tb\tnull"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_tsv(df, out, ["k"])
    write_tsv(df.filter("k = '1'"), out, ["k"], mode="overwrite")
    assert [r.value for r in spark.read.text(out).collect()] == ["1"]


def test_read_json_fixed_schema(spark, tmp_path):
    p = tmp_path / "people.json"
    p.write_text('{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}\n')
    df = read_json(spark, str(p), "name string, age bigint")
    assert rows(df) == [("Andy", 30), ("Justin", 19), ("Michael", None)]


def test_line_order_across_many_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 7) for i in range(3000)]
    p = tmp_path / "big.txt"
    p.write_text("\n".join(lines) + "\n")
    (tmp_path / "other.txt").write_text("a\nb\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = read_lines(spark, [str(p), str(tmp_path / "other.txt")], with_order=True)
        assert df.rdd.getNumPartitions() > 10
        got = [r.value for r in df.orderBy("line_order").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == lines + ["a", "b"]
