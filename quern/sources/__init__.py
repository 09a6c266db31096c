"""Sources and sinks: text lines, JSON lines, tab-separated text output."""

from quern.sources.json import read_json
from quern.sources.sinks import tsv_line, write_tsv
from quern.sources.text import parse_pairs, parse_table, read_lines, route_by_suffix

__all__ = ["parse_pairs", "parse_table", "read_json", "read_lines", "route_by_suffix",
           "tsv_line", "write_tsv"]
