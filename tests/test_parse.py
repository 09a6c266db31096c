"""P5-P7 and the A8 counts: field-count rules and number parsing."""

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql.utils import AnalysisException

from quern.sources import parse_pairs, parse_table


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_table_arity_and_observe(spark):
    df = _lines(spark, ["1 n 1 901 1", "1 n 1 901 1 x", " 2G 123 1", "", "a b c d e"])
    out, obs = parse_table(df, ["a", "b", "c", "d", "e"], observe="arity")
    got = rows(out)
    assert got == [("1", "n", "1", "901", "1"), ("a", "b", "c", "d", "e")]
    assert obs.get == {"rows_in": 5, "rows_rejected": 3}


def test_leading_blank_counts_as_field(spark):
    out = parse_table(_lines(spark, [" 2G 123 1"]), ["userID", "network", "flow", "cityID"])
    assert rows(out) == [("", "2G", "123", "1")]


def test_limited_parse_accepts_long_rows(spark):
    out = parse_table(_lines(spark, ["1 n 1 901 1 x", "short row"]), ["a", "b", "c", "d", "e"], limit=5)
    assert rows(out) == [("1", "n", "1", "901", "1 x")]


def test_drop_empty(spark):
    out = parse_table(_lines(spark, ["", "x"]), ["only"], drop_empty=True)
    assert rows(out) == [("x",)]


def test_pairs_lenient(spark):
    df = _lines(spark, ["3 1", "+5 2 extra", "x 1", "3", "1.5 2", "99999999999999999999 1",
                        "0 0", "4294967296 0", " 7 8"])
    out = parse_pairs(df, mode="lenient")
    assert rows(out) == [(0, 0), (3, 1), (5, 2), (4294967296, 0)]


def test_pairs_strict_fails(spark):
    for bad in (["1 2", "x 1"], ["1 2", "3"]):
        with pytest.raises((PySparkException, AnalysisException, Exception)):
            parse_pairs(_lines(spark, bad), mode="strict").collect()
    assert rows(parse_pairs(_lines(spark, ["2 1", "1 1"]), mode="strict")) == [(1, 1), (2, 1)]


def test_observed_counts_on_a_driver_table(spark):
    """The counts taken while a job runs equal those of a query over the same lines."""
    from quern.plans import queries

    sf = "/root/testdata/sf0.001"
    out, obs = parse_table(queries._document_lines(spark, sf), ["a", "b", "c", "d", "e"], observe="driver_lines")
    kept = out.count()
    want = queries.field_arity_counts(spark, sf).first()
    assert (obs.get["rows_in"], obs.get["rows_rejected"]) == (want["rows_in"], want["rows_rejected"])
    assert kept == want["rows_in"] - want["rows_rejected"]


def test_stage_counts_come_back_as_rows(spark):
    from pyspark.sql import functions as F

    from quern.operators.metrics import StageCounts

    counts = StageCounts()
    lines = counts.watch(_lines(spark, ["a b", "c", "", "d e"]), "lines")
    kept = counts.accept(lines, "arity", F.size(F.split("value", " ")) == 2).filter(F.size(F.split("value", " ")) == 2)
    last = counts.watch(kept, "kept", n=F.count(F.lit(1)), longest=F.max(F.length("value")).cast("long"))
    with pytest.raises(ValueError):
        counts.add("kept", None)
    assert last.count() == 2
    assert rows(counts.rows(spark), order="keep") == [
        ("lines", "rows", 4), ("arity", "rows_in", 4), ("arity", "rows_rejected", 2), ("kept", "n", 2), ("kept", "longest", 3)]
    assert rows(counts.row(spark, "arity")) == [(4, 2)] and counts.row(spark, "arity").columns == ["rows_in", "rows_rejected"]
    empty = StageCounts()
    assert rows(empty.run(empty.watch(_lines(spark, []), "none")).rows(spark)) == [("none", "rows", 0)]


def test_routed_layout_keeps_a_key_in_one_partition(spark):
    from pyspark.sql import functions as F

    from quern.plans import queries

    out = queries.secondary_sort_routed(spark, "/root/testdata/sf0.001").withColumn("p", F.spark_partition_id()).collect()
    place = {}
    for r in out:
        assert place.setdefault(r["key"], r["p"]) == r["p"]
    for p in set(place.values()):
        own = [(r["key"], r["tag"]) for r in out if r["p"] == p]
        assert own == sorted(own)
