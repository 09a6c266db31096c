"""Text sources (S1, S2) and the line parsers (P3-P7) that type them.

A table in the reference is a text file: no header, positional fields, and
a field-count rule that silently drops malformed lines. ``parse_table``
keeps that rule but makes the field names, the separator and the split
limit explicit arguments, because jobs that look alike use different rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import WS_RUN, java_split
from quern.operators.metrics import count_accepted

# Fixed value: the digits a Java Long.parseLong accepts (optional sign, ASCII digits).
_LONG_TEXT = r"^[+-]?[0-9]+$"


def keep_where(df: DataFrame, cond: Column, cols: list[Column], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of ``df`` where ``cond`` holds, projected to ``keep`` + ``cols``.

    Written as a generator (0 or 1 output rows per input row) rather than a
    filter: the optimizer pushes a filter below the projection that computes
    a split array and would copy the split into the condition, evaluating it
    again per use. A generator is not inlined, so the array is computed once.
    """
    return df.select(*keep, F.inline(F.when(cond, F.array(F.struct(*cols)))))


def read_lines(spark: SparkSession, path: str | Sequence[str], with_source: bool = False,
               source_col: str = "source_file", with_order: bool = False,
               order_col: str = "line_order") -> DataFrame:
    """One row per line, column ``value``; LF, CRLF and CR end lines.

    ``with_source`` adds the file name of each line (S2), for a mixed read
    routed by ``route_by_suffix``. ``with_order`` adds ``order_col``, a
    struct (file path, split start, row id) that sorts lines in file order:
    rows of one split are read in sequence and get increasing row ids, and
    the split start orders the splits of a file. Re-reading the same files
    gives the same values.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.text(paths)
    cols = [F.col("value")]
    if with_source:
        cols.append(F.col("_metadata.file_name").alias(source_col))
    if with_order:
        cols.append(F.struct(F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.file_block_start").alias("start"),
                             F.monotonically_increasing_id().alias("row")).alias(order_col))
    return df.select(*cols)


def route_by_suffix(df: DataFrame, suffix: str, source_col: str = "source_file") -> DataFrame:
    """The lines of files whose name ends with ``suffix`` (the reference's routing rule)."""
    return df.filter(F.col(source_col).endswith(suffix)).drop(source_col)


def parse_table(df: DataFrame, names: Sequence[str], sep: str = WS_RUN, limit: int = 0,
                value_col: str = "value", keep: Sequence[str] = (), drop_empty: bool = False,
                observe: str | None = None) -> DataFrame | tuple[DataFrame, Observation]:
    """P3/P4 + P6/P7: split each line, keep lines with exactly ``len(names)`` fields.

    ``limit=0`` is Java's unlimited split (trailing empty fields dropped);
    ``limit=n`` stops after n fields, the last keeping the rest of the line,
    so an over-long line is accepted. ``drop_empty`` drops empty lines first.
    Fields stay strings. With ``observe`` set, returns ``(df, observation)``
    whose ``rows_in`` / ``rows_rejected`` are filled after an action (A8).
    """
    n = len(names)
    src = df.filter(F.col(value_col) != F.lit("")) if drop_empty else df
    parts = src.select(*keep, java_split(value_col, sep, limit).alias("_f"))
    obs = None
    if observe:
        parts, obs = count_accepted(parts, observe, F.size("_f") == F.lit(n))
    cols = [F.get(F.col("_f"), i).alias(name) for i, name in enumerate(names)]
    out = keep_where(parts, F.size("_f") == F.lit(n), cols, keep)
    return (out, obs) if observe else out


def _long(text: Column) -> Column:
    return F.when(text.rlike(_LONG_TEXT), text.try_cast("bigint"))


def parse_pairs(df: DataFrame, names: Sequence[str] = ("first_num", "second_num"),
                mode: str = "strict", value_col: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """P5: the first two whitespace-separated fields as 64-bit integers; more fields are ignored.

    ``strict`` fails the job on a line with fewer than two fields or a field
    Java's ``Long.parseLong`` would reject (sign and ASCII digits only, in
    range); ``lenient`` drops such lines instead. The check does not depend
    on the session's ANSI setting.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError("mode must be 'strict' or 'lenient'")
    parts = df.select(*keep, F.col(value_col).alias("_line"),
                      java_split(value_col, WS_RUN).alias("_f"))
    typed = parts.select(*keep, "_line", _long(F.get(F.col("_f"), 0)).alias("_a"),
                         _long(F.get(F.col("_f"), 1)).alias("_b"))
    ok = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    if mode == "strict":
        ok = F.when(ok, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("malformed number pair: "), F.col("_line"))))
    return keep_where(typed, ok, [F.col("_a").alias(names[0]), F.col("_b").alias(names[1])], keep)
