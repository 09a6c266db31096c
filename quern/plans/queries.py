"""The registered queries: each operator of the inventory run over the driver's tables.

Every query reads whole tables (parquet, only the columns it needs, so the
scan prunes) and returns a lazy DataFrame. Column names match the oracle
SQL in ``quern.plans.oracle`` exactly. Outputs avoid timestamp columns,
whose rendering differs between engines; timestamps are still used for
ordering.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import fields, lines
from quern.operators import agg, bloom, joins, layout
from quern.operators.metrics import StageCounts
from quern.sources.sinks import tsv_line
from quern.sources.text import parse_pairs, parse_table

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


# ---------------------------------------------------------------- token counts

def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """StringTokenizer tokens of every document, counted."""
    docs = table(spark, sf_dir, "documents", "text")
    return agg.token_count(docs, "text", splitter="tokens")


def space_split_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """split(" ") tokens, each line feed first made two blanks (so empty tokens occur)."""
    docs = table(spark, sf_dir, "documents", "text")
    line = F.regexp_replace("text", "\n", "  ")
    return agg.token_count(docs.select(line.alias("line")), "line", splitter="space")


def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: token counts per source, then the partial counts summed per token."""
    docs = table(spark, sf_dir, "documents", "source", "text")
    per_source = agg.token_count(docs, "text", by=["source"])
    return agg.merge_counts(per_source, "word")


def token_count_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + O5: token counts in a fixed number of hash partitions, each key-sorted.

    The reference fixes two reducers; the file count is a parameter here
    (``jobs.word_count(reducers=2)`` keeps the reference's), and this query
    uses the session's shuffle partition count so the layout grows with the
    cluster rather than putting every distinct token into two tasks.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return layout.partitioned_sorted(token_count(spark, sf_dir), "word", n)


# ------------------------------------------------------------ parsing lines

def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", F.explode(lines("text")).alias("value"))


def field_arity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents that split into exactly five fields."""
    names = ["f0", "f1", "f2", "f3", "f4"]
    return parse_table(_document_lines(spark, sf_dir), names, keep=["doc_id"])


def field_arity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in and lines rejected by the five-field rule, counted while the parse runs.

    The parse is the action; its counts come back as a row.
    """
    counts = StageCounts()
    out, obs = parse_table(_document_lines(spark, sf_dir), ["f0", "f1", "f2", "f3", "f4"], observe="field_arity")
    counts.add("field_arity", obs)
    return counts.run(out).row(spark, "field_arity")


def token_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 over A2: lines in, groups out and tokens of the single-space token count, as the reference prints them."""
    lines_in = _document_lines(spark, sf_dir).select("value")
    out, lines_obs, groups_obs = agg.token_count_observed(lines_in, "value", splitter="space", name="space_count")
    counts = StageCounts()
    counts.add("map", lines_obs)
    counts.add("reduce", groups_obs)
    return counts.run(out).rows(spark)


def nonempty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents that is not empty, as one field."""
    return parse_table(_document_lines(spark, sf_dir), ["line"], limit=1, keep=["doc_id"], drop_empty=True)


def fields_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """split(text, "\\s+", 3): keep texts with three fields; the last is the verbatim rest."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return parse_table(docs, ["first", "second", "rest"], limit=3, value_col="text", keep=["doc_id"])


def _pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem (l_partkey, l_suppkey) as text lines; line number 7 made non-numeric, 6 one field short."""
    li = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_linenumber")
    pk, sk = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    value = (F.when(F.col("l_linenumber") == 7, F.concat(F.lit("x"), pk, F.lit(" "), sk))
             .when(F.col("l_linenumber") == 6, pk)
             .otherwise(F.concat(pk, F.lit(" "), sk)))
    return li.select(value.alias("value"))


def parse_pairs_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 P5 (strict): every lineitem pair rendered as text and parsed back; a bad line would fail the job."""
    li = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey")
    value = F.concat_ws(" ", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    return parse_pairs(li.select(value.alias("value")), mode="strict")


def parse_pairs_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 P5 (lenient): number pairs parsed from text, malformed lines dropped."""
    return parse_pairs(_pair_lines(spark, sf_dir), mode="lenient")


# ------------------------------------------------------- grouping and order

def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey")
    return li.select(F.col("l_partkey").alias("first_num"), F.col("l_suppkey").alias("second_num"))


def sorted_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: every pair, sorted by the first number."""
    pairs = _pairs(spark, sf_dir)
    return agg.sorted_rows(pairs, ["first_num"])


def sorted_pairs_by_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: every pair, sorted by both numbers."""
    pairs = _pairs(spark, sf_dir)
    return agg.sorted_rows(pairs, ["first_num", "second_num"])


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 O2: distinct pairs in key order."""
    pairs = _pairs(spark, sf_dir)
    return agg.distinct_pairs(pairs, ["first_num", "second_num"])


def min_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: smallest second number per first number."""
    return agg.min_per_key(_pairs(spark, sf_dir), "first_num", "second_num")


def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's first order by (date, order key)."""
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    return agg.first_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey"])


def first_of_run_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 per user: first event of each run of equal event types, in (ts, event_id) order."""
    ev = table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type")
    out = agg.first_of_run(ev, ["event_type"], ["ts", "event_id"], partition_cols=["user_id"])
    return out.select("user_id", "event_id", "event_type")


def first_of_run_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 global: first event of each run of equal event types, in event_id order."""
    ev = table(spark, sf_dir, "events", "event_id", "event_type")
    out = agg.first_of_run(ev, ["event_type"], ["event_id"])
    return out.select("event_id", "event_type")


# -------------------------------------------------------------------- joins

def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")


def _building_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key list: distinct keys of the BUILDING customers."""
    cust = _customers(spark, sf_dir).filter(F.col("c_mktsegment") == "BUILDING")
    return joins.join_keys(cust, "c_custkey", "join_key")


def join_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key list of the orders, the distinct customers that have any."""
    return joins.join_keys(table(spark, sf_dir, "orders", "o_custkey"), "o_custkey", "join_key")


def inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its line items, shuffled and merged (both tables are large)."""
    orders = _orders(spark, sf_dir).hint("merge")
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    return joins.equi_join(orders, li, "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey")


def left_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with each of its orders, or NULLs if it has none; shuffled and merged."""
    cust = _customers(spark, sf_dir).select("c_custkey", "c_name").hint("merge")
    out = joins.equi_join(cust, _orders(spark, sf_dir), "c_custkey", "o_custkey", how="left", strategy="shuffle")
    return out.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


def left_outer_join_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + S5: the left outer join rendered as the reference writes it.

    ``key TAB name TAB order TAB status``, or ``key TAB name TAB null`` for a
    customer without a matching order: one ``null`` for the whole missing
    side, not one per field.
    """
    cust = _customers(spark, sf_dir).select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    out = joins.equi_join(cust, orders, "c_custkey", "o_custkey", how="left")
    line = tsv_line(["c_custkey", "c_name"], null_groups=[("o_orderkey", ["o_orderkey", "o_orderstatus"])])
    return out.select(line.alias("value"))


def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with the last supplier (greatest key) of its nation."""
    cust = _customers(spark, sf_dir).select("c_custkey", "c_name", "c_nationkey")
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    out = joins.lookup_join(cust, sup, "c_nationkey", "s_nationkey", ["s_name"], order="s_suppkey")
    return out.select("c_custkey", "c_name", "c_nationkey", "s_name")


def lookup_join_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + O6: the lookup join in key order, as an identity reducer would write it."""
    cust = _customers(spark, sf_dir).select("c_custkey", "c_name", "c_nationkey")
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    out = joins.lookup_join(cust, sup, "c_nationkey", "s_nationkey", ["s_name"], order="s_suppkey", sort_output=True)
    return out.select("c_custkey", "c_name", "c_nationkey", "s_name")


def prefiltered_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders both cut to the key list, then joined."""
    cust = _customers(spark, sf_dir).select("c_custkey", "c_name")
    out = joins.prefiltered_join(cust, _orders(spark, sf_dir), "c_custkey", "o_custkey",
                                 _building_keys(spark, sf_dir))
    return out.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


def bloom_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders cut by a Bloom filter of the key list, joined to the listed customers."""
    cust = _customers(spark, sf_dir).select("c_custkey", "c_name")
    out = joins.bloom_join(_orders(spark, sf_dir), cust, "o_custkey", "c_custkey",
                           _building_keys(spark, sf_dir), exact=True)
    return out.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


def bloom_sizing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bits and hash count of a 1 % filter over the customers that have orders."""
    n = F.count_distinct("o_custkey")
    m, k = bloom.size_columns(n, 0.01)
    return table(spark, sf_dir, "orders", "o_custkey").agg(n.alias("n_keys"), m.alias("bits"), k.alias("hashes"))


def secondary_sort_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BUILDING customers (tag 0) enrich all orders (tag 1) by secondary sort."""
    cust = _customers(spark, sf_dir).filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    # The window strategy is forced so the query exercises the secondary-sort
    # mechanism itself; "auto" would take a map-side lookup for a dimension
    # this small (at full scale the BUILDING customers are too many for that).
    out = joins.secondary_sort_join(cust, _orders(spark, sf_dir), "c_custkey", "o_custkey",
                                    ["c_name"], ["o_orderkey", "o_totalprice"], dim_order="c_custkey",
                                    strategy="window")
    return out.select(F.col("o_custkey").alias("c_custkey"), "c_name", "o_orderkey", "o_totalprice")


def secondary_sort_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tagged union of customers and their orders, routed by key, sorted by (key, tag)."""
    cust = _customers(spark, sf_dir).select("c_custkey", "c_name")
    orders = _orders(spark, sf_dir).select("o_custkey", "o_orderkey")
    flow = joins.tagged_union(cust, orders, "c_custkey", "o_custkey")
    flow = layout.secondary_sort(flow, "key", ["tag"], split_hot_keys=True)
    return flow.select("key", "tag", F.col("dim.c_name").alias("c_name"), F.col("rec.o_orderkey").alias("o_orderkey"))


def secondary_sort_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 as the reference has it: every row of a key in the key's one partition, in (key, tag) order."""
    flow = joins.tagged_union(_customers(spark, sf_dir).select("c_custkey", "c_name"),
                              _orders(spark, sf_dir).select("o_custkey", "o_orderkey"), "c_custkey", "o_custkey")
    flow = layout.secondary_sort(flow, "key", ["tag"])
    return flow.select("key", "tag", F.col("dim.c_name").alias("c_name"), F.col("rec.o_orderkey").alias("o_orderkey"))


def cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers and the suppliers of each nation together, with how many there are of each."""
    cust = _customers(spark, sf_dir).select("c_custkey", "c_name", "c_nationkey")
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    met = joins.cogroup(cust, sup, "c_nationkey", "s_nationkey", ["c_custkey", "c_name"],
                        ["s_suppkey", "s_name"], key_col="nationkey")
    return met.select("nationkey", "side", F.coalesce("left_row.c_custkey", "right_row.s_suppkey").alias("row_key"),
                      F.coalesce("left_row.c_name", "right_row.s_name").alias("row_name"),
                      F.col("n_left").alias("n_customers"), F.col("n_right").alias("n_suppliers"))


def cogroup_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 as lists: each nation's customers and suppliers, in key order, in chunks of 25; the lists as text."""
    cust = _customers(spark, sf_dir).select("c_custkey", "c_name", "c_nationkey")
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    met = joins.cogroup_lists(cust, sup, "c_nationkey", "s_nationkey", ["c_custkey", "c_name"], ["s_suppkey", "s_name"],
                              ["c_custkey"], ["s_suppkey"], key_col="nationkey", chunk_rows=25)

    def text(rows: str, key: str, name: str) -> Column:
        return F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r[key], r[name])), ",")

    return met.select("nationkey", "chunk", F.col("n_left").alias("n_customers"), F.col("n_right").alias("n_suppliers"),
                      text("left_rows", "c_custkey", "c_name").alias("customers"),
                      text("right_rows", "s_suppkey", "s_name").alias("suppliers"))


QUERIES: dict[str, Query] = {
    "token_count": token_count,
    "space_split_count": space_split_count,
    "merge_counts": merge_counts,
    "token_count_layout": token_count_layout,
    "field_arity_filter": field_arity_filter,
    "field_arity_counts": field_arity_counts,
    "token_stage_counts": token_stage_counts,
    "nonempty_lines": nonempty_lines,
    "fields_limit": fields_limit,
    "parse_pairs": parse_pairs_lenient,
    "parse_pairs_strict": parse_pairs_strict,
    "sorted_pairs": sorted_pairs,
    "sorted_pairs_by_two": sorted_pairs_by_two,
    "distinct_pairs": distinct_pairs,
    "min_per_key": min_per_key,
    "first_per_key": first_per_key,
    "first_of_run_by_user": first_of_run_by_user,
    "first_of_run_global": first_of_run_global,
    "join_keys": join_keys,
    "inner_join": inner_join,
    "left_outer_join": left_outer_join,
    "left_outer_join_tsv": left_outer_join_tsv,
    "lookup_join": lookup_join,
    "lookup_join_sorted": lookup_join_sorted,
    "prefiltered_join": prefiltered_join,
    "bloom_join": bloom_join,
    "bloom_sizing": bloom_sizing,
    "secondary_sort_join": secondary_sort_join,
    "secondary_sort_layout": secondary_sort_layout,
    "secondary_sort_routed": secondary_sort_routed,
    "cogroup": cogroup,
    "cogroup_lists": cogroup_lists,
}
