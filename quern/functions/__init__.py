"""Column expressions (JVM-side, whole-stage-codegen friendly)."""

from quern.functions.text import (
    LINE_BREAK,
    SPACE,
    TOKEN_DELIMITERS,
    WS_RUN,
    fields,
    java_split,
    lines,
    split_single_space,
    tokens,
)

__all__ = [
    "LINE_BREAK", "SPACE", "TOKEN_DELIMITERS", "WS_RUN",
    "fields", "java_split", "lines", "split_single_space", "tokens",
]
