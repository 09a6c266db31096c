"""The reference's ten text jobs, end to end: text files in, tab-separated text out.

Each job reads whitespace-delimited lines, applies the job's own parsing
rule (field count, split limit, strict or lenient numbers), runs the
operator, and writes ``key TAB value`` lines. Each returns the result
DataFrame as well, so it can be inspected or written elsewhere.

Arrival order, which two jobs depend on (last dimension row wins; first
row of a run), is the file order of the lines (``read_lines(with_order)``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import agg, joins, layout
from quern.sources.sinks import write_tsv
from quern.sources.text import parse_pairs, parse_table, read_lines, route_by_suffix

# Field layouts of the reference's sample tables.
CITY_FIELDS = ["id", "name", "orderid", "city_code", "is_show"]
USER_FIELDS = ["userID", "network", "flow", "cityID"]
STATION_FIELDS = ["station_id", "station_name"]
RECORD_FIELDS = ["station_id", "ts", "temperature"]
# The file-name endings that route lines of a mixed read.
LEFT_SUFFIX, RIGHT_SUFFIX = "left_table.txt", "right_table.txt"

Paths = str | Sequence[str]


def _write(df: DataFrame, out: str | None, columns: Sequence[str], mode: str,
           null_groups=()) -> DataFrame:
    if out is not None:
        write_tsv(df, out, columns, null_groups=null_groups, mode=mode)
    return df


def word_count(spark: SparkSession, inputs: Paths, out: str | None = None,
               reducers: int = 2, mode: str = "overwrite") -> DataFrame:
    """StringTokenizer token count, ``reducers`` key-sorted output files; replaces the output."""
    counts = agg.token_count(read_lines(spark, inputs), "value")
    counts = layout.partitioned_sorted(counts, "word", reducers)
    return _write(counts, out, ["word", "cnt"], mode)


def space_word_count(spark: SparkSession, inputs: Paths, out: str | None = None,
                     reducers: int = 2, mode: str = "errorifexists") -> DataFrame:
    """split(" ") token count with 64-bit sums; refuses an existing output folder."""
    counts = agg.token_count(read_lines(spark, inputs), "value", splitter="space")
    counts = layout.partitioned_sorted(counts, "word", reducers)
    return _write(counts, out, ["word", "cnt"], mode)


def sort_pairs(spark: SparkSession, inputs: Paths, out: str | None = None,
               mode: str = "overwrite") -> DataFrame:
    """Number pairs sorted by the first number, all rows kept; a malformed line fails the job."""
    lines = read_lines(spark, inputs)
    pairs = parse_pairs(lines, mode="strict")
    sorted_pairs = agg.sorted_rows(pairs, ["first_num"])
    return _write(sorted_pairs, out, ["first_num", "second_num"], mode)


def group_pairs(spark: SparkSession, inputs: Paths, out: str | None = None,
                as_coded: bool = True, mode: str = "overwrite") -> DataFrame:
    """Two-column key grouping. As coded: the distinct pairs in order. As meant: min per first number."""
    lines = read_lines(spark, inputs)
    pairs = parse_pairs(lines, mode="strict")
    if as_coded:
        result = agg.distinct_pairs(pairs, ["first_num", "second_num"])
    else:
        mins = agg.min_per_key(pairs, "first_num", "second_num")
        result = mins.repartitionByRange("first_num").sortWithinPartitions("first_num")
    return _write(result, out, ["first_num", "second_num"], mode)


def first_pair_per_group(spark: SparkSession, inputs: Paths, out: str | None = None,
                         as_coded: bool = True, mode: str = "overwrite") -> DataFrame:
    """Grouping by the first number with a sort inside the group.

    As coded the sort says every pair is equal, so each run of equal first
    numbers in file order gives its first pair (A7); as meant, each first
    number gives its pair with the smallest second number (A6).
    """
    lines = read_lines(spark, inputs, with_order=True)
    pairs = parse_pairs(lines, mode="strict", keep=["line_order"])
    if as_coded:
        result = agg.first_of_run(pairs, ["first_num"], ["line_order"])
    else:
        result = agg.first_per_key(pairs, "first_num", ["second_num"], ["second_num"])
    return _write(result.select("first_num", "second_num"), out, ["first_num", "second_num"], mode)


def _city_user_tables(spark: SparkSession, inputs: Paths) -> tuple[DataFrame, DataFrame]:
    mixed = read_lines(spark, inputs, with_source=True)
    left = parse_table(route_by_suffix(mixed, LEFT_SUFFIX), CITY_FIELDS)
    right = parse_table(route_by_suffix(mixed, RIGHT_SUFFIX), USER_FIELDS)
    return left, right


def reduce_side_join(spark: SparkSession, inputs: Paths, out: str | None = None,
                     mode: str = "overwrite") -> DataFrame:
    """Left outer join of cities and users on id = cityID; an unmatched city ends in ``null``."""
    left, right = _city_user_tables(spark, inputs)
    joined = joins.equi_join(left, right.select("cityID", "userID", "network", "flow"),
                             "id", "cityID", how="left")
    result = joined.select("id", "name", "orderid", "city_code", "is_show", "cityID",
                           "userID", "network", "flow")
    return _write(result, out, ["id", "name", "orderid", "city_code", "is_show"], mode,
                  null_groups=[("cityID", ["userID", "network", "flow"])])


def map_side_join(spark: SparkSession, dim_path: Paths, big_path: Paths, out: str | None = None,
                  mode: str = "overwrite", sort_output: bool = True) -> DataFrame:
    """Broadcast lookup: users (limit-4 split) find their city (limit-5 split); inner; last city row wins."""
    dim_lines = read_lines(spark, dim_path, with_order=True)
    dim = parse_table(dim_lines, CITY_FIELDS, limit=5, keep=["line_order"])
    big_lines = read_lines(spark, big_path)
    big = parse_table(big_lines, USER_FIELDS, limit=4, drop_empty=True)
    result = joins.lookup_join(big, dim, "cityID", "id", CITY_FIELDS[1:], order="line_order",
                               sort_output=sort_output)
    result = result.select("id", "name", "orderid", "city_code", "is_show", "userID", "network", "flow")
    return _write(result, out, result.columns, mode)


def _key_list(spark: SparkSession, key_path: Paths) -> DataFrame:
    return read_lines(spark, key_path).select(F.col("value").alias("join_key"))


def semi_join(spark: SparkSession, inputs: Paths, key_path: Paths, out: str | None = None,
              mode: str = "overwrite") -> DataFrame:
    """Both tables cut to the listed keys (lines taken verbatim), then inner joined."""
    left, right = _city_user_tables(spark, inputs)
    joined = joins.prefiltered_join(left, right, "id", "cityID", _key_list(spark, key_path))
    result = joined.select("id", "name", "orderid", "city_code", "is_show", "userID", "network", "flow")
    return _write(result, out, result.columns, mode)


def bloom_filter_join(spark: SparkSession, inputs: Paths, key_path: Paths, out: str | None = None,
                      exact: bool = False, fpr: float = 0.01, mode: str = "overwrite") -> DataFrame:
    """Cities cut by a Bloom filter of the key list, inner joined with all users.

    Only (name, orderid) and (network, flow) are kept. ``exact=False`` is the
    reference's behaviour: a city that passes the filter by chance and has
    users reaches the output.
    """
    left, right = _city_user_tables(spark, inputs)
    joined = joins.bloom_join(left.select("id", "name", "orderid"),
                              right.select("cityID", "network", "flow"),
                              "id", "cityID", _key_list(spark, key_path), fpr=fpr, exact=exact)
    result = joined.select("id", "name", "orderid", "network", "flow")
    return _write(result, out, result.columns, mode)


def secondary_sort_join(spark: SparkSession, station_path: Paths, record_path: Paths,
                        out: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Weather records enriched with their station name by a tagged-union secondary sort."""
    stations = parse_table(read_lines(spark, station_path, with_order=True), STATION_FIELDS,
                           keep=["line_order"])
    records = parse_table(read_lines(spark, record_path), RECORD_FIELDS)
    joined = joins.secondary_sort_join(stations, records, "station_id", "station_id",
                                       ["station_name"], ["ts", "temperature"], dim_order="line_order")
    result = joined.select("station_id", "station_name", "ts", "temperature")
    return _write(result, out, result.columns, mode)


JOBS = {
    "word_count": word_count,
    "space_word_count": space_word_count,
    "sort_pairs": sort_pairs,
    "group_pairs": group_pairs,
    "first_pair_per_group": first_pair_per_group,
    "reduce_side_join": reduce_side_join,
    "map_side_join": map_side_join,
    "semi_join": semi_join,
    "bloom_filter_join": bloom_filter_join,
    "secondary_sort_join": secondary_sort_join,
}
