"""Run one of the reference's text jobs from the command line.

    python -m quern JOB INPUT [INPUT ...] OUTPUT [--mode overwrite|errorifexists]
    spark-submit quern/__main__.py JOB INPUT ... OUTPUT

Inputs are given in the job's argument order, e.g.
``map_side_join CITY_FILE USER_FILE OUT`` or ``semi_join 'join/*.txt' KEY_FILE OUT``.
The session is whatever ``SparkSession.builder.getOrCreate()`` returns, so
cluster settings come from spark-submit; the web UI stays off unless
``--ui`` is given.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from quern.plans.jobs import JOBS


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quern", description="Run a text job.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("paths", nargs="+", help="input paths in the job's order, then the output folder")
    parser.add_argument("--mode", default=None, help="write mode (default: the job's own)")
    parser.add_argument("--ui", action="store_true", help="start the Spark web UI (off by default)")
    args = parser.parse_args(argv)

    job = JOBS[args.job]
    *inputs, out = args.paths
    n_inputs = sum(1 for p in list(inspect.signature(job).parameters)[1:] if p != "out" and
                   inspect.signature(job).parameters[p].default is inspect.Parameter.empty)
    if len(inputs) != n_inputs:
        parser.error(f"{args.job} takes {n_inputs} input path(s) and an output folder")
    kwargs = {"out": out}
    if args.mode:
        kwargs["mode"] = args.mode
    builder = SparkSession.builder.appName(f"quern-{args.job}")
    if not args.ui:
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    job(spark, *inputs, **kwargs)


if __name__ == "__main__":
    main()
