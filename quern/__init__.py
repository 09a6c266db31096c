"""quern: batch text-analytics and join operators on the Spark DataFrame API.

Every operator takes and returns DataFrames (or Columns). Nothing is collected
to the driver except bounded scalars used to size a plan (a broadcast check,
a Bloom filter size), and no per-row Python runs in the operators.

Layout:
    quern.functions  column expressions: tokenising and Java-style splitting
    quern.sources    text / JSON readers, line parsers, the TSV sink
    quern.operators  aggregation, ordering, joins, Bloom filter, layouts, metrics
    quern.plans      the registered queries over the driver's parquet tables
"""

from quern.session import ensure_checkpoint_dir, local_session

__all__ = ["ensure_checkpoint_dir", "local_session"]
