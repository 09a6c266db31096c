"""Helpers the operators share: reading, checkpoints, and texts as arrays of pieces.

Texts are cut into pieces (tokens of a pattern, or words) by Spark's own
regular expressions. Python then sees each Arrow batch as distinct pieces
plus integer positions, so per-piece work is done once per distinct piece
of a batch and the rest is vectorised.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import ensure_checkpoint_dir

# Characters of text worked on at once inside a task; bounds a worker's memory
# (a single longer text is still worked on whole).
SLICE_CHARS = 4_000_000

# Fixed value: the byte-level pattern of the public vocabularies (the same
# pieces as public_tokenizers.PATTERN), in Java's notation: white space is
# Unicode's property, as in the pattern's own library.
PIECE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+"
                 r"|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+")


def import_on_workers(spark: SparkSession) -> None:
    """Put this package's place on the Python workers' path, for a driver that was not started from it.

    For workers that see the driver's files; elsewhere the package is installed or sent with --py-files.
    """
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    places = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in places:
        env["PYTHONPATH"] = os.pathsep.join([*places, root])


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving the memory it has freed back to the machine when it ends.

    Spark keeps its Python workers for later tasks, and what an allocator
    holds on to would stay with the executor through all stages that follow.
    """
    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # of the GNU C library
            if trim:
                trim(0)

    return again


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    import_on_workers(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the cluster's shared checkpoint folder, and read from there.

    Cuts the lineage like ``DataFrame.checkpoint()``, but the table is
    compressed and read by columns, and the plan that made it (with all that
    the optimizer derived from it) does not live on in the plans that read it.
    """
    spark = df.sparkSession
    place = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4()}"
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def token_pieces(text: str | Column) -> Column:
    """The text's pieces under ``PIECE_PATTERN``, in order; they join to the whole text (NULL: none)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(PIECE_PATTERN), F.lit(0))


def words(text: str | Column) -> Column:
    """Runs of characters between white space (NULL or blank text: none)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"\P{IsWhite_Space}+"), F.lit(0))


def slices(batches: Iterator[pa.RecordBatch], pieces: str, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``SLICE_CHARS`` bytes of pieces, and ``most`` pieces if given, or one row."""
    for batch in batches:
        arr = batch.column(batch.schema.get_field_index(pieces))
        if len(arr) == 0:
            continue
        flat = arr.flatten()
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False))])
        size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
        at = size[ends]
        start = 0
        while start < len(arr):
            stop = int(np.searchsorted(at, at[start] + SLICE_CHARS, side="right")) - 1
            if most:
                stop = min(stop, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
            stop = min(len(arr), max(start + 1, stop))
            yield batch.slice(start, stop - start)
            start = stop


def distinct_pieces(arr: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(distinct, index, bounds)``: piece j is ``distinct[index[j]]``, row i owns ``bounds[i]:bounds[i + 1]``."""
    lengths = pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    coded = arr.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), bounds


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each row's range (empty ranges: 0)."""
    run = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return run[bounds[1:]] - run[bounds[:-1]]


def row_ranges(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to at most ``most``, or of one row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, side="right"))
        stop = max(start + 1, stop)
        yield start, stop
        start = stop


def gather_ranges(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[starts[i] : starts[i] + lengths[i]]`` for every i."""
    total = int(lengths.sum())
    if total == 0:
        return flat[:0]
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return flat[shift + np.arange(total)]


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in byte order.
    """
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


def vocabulary_bytes(path: str) -> dict[bytes, int]:
    """Bytes -> id of a byte-level vocabulary in the ``tokenizers`` JSON format, special tokens left out."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    back = {c: b for b, c in byte_symbols().items()}
    return {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
