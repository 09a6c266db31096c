"""Text sink (S5-S7): ``key TAB value`` lines, as the reference's jobs write them.

Each field is rendered as text; a NULL field becomes ``null`` (Java string
concatenation). A *group* of columns that stands for one side of an outer
join is rendered as one field ``null`` when its presence column is NULL,
which gives the reference's ragged unmatched rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _field(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit("null"))


def tsv_line(columns: Sequence[str | Column],
             null_groups: Sequence[tuple[str, Sequence[str]]] = ()) -> Column:
    """One tab-separated line from ``columns`` followed by the ``null_groups``.

    ``null_groups`` is a list of ``(presence_col, cols)``: the group's fields,
    or the single field ``null`` when ``presence_col`` is NULL.
    """
    parts = [_field(c) for c in columns]
    for presence, cols in null_groups:
        body = F.concat_ws("\t", *[_field(c) for c in cols])
        parts.append(F.when(F.col(presence).isNull(), F.lit("null")).otherwise(body))
    return F.concat_ws("\t", *parts)


def write_tsv(df: DataFrame, path: str, columns: Sequence[str | Column],
              null_groups: Sequence[tuple[str, Sequence[str]]] = (),
              mode: str = "errorifexists") -> None:
    """Write ``df`` as tab-separated text lines.

    ``mode="errorifexists"`` (default) refuses an existing output folder (S7);
    ``mode="overwrite"`` replaces it (S6). Lay the rows out first with
    ``quern.operators.layout`` for a fixed number of key-sorted files (O5).
    """
    df.select(tsv_line(columns, null_groups).alias("value")).write.mode(mode).text(path)
