"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_keep_leading(s: Column | str, sep: str = "-") -> Column:
    """Split like the JVM ``String.split``: trailing empty parts are dropped.

    ``"a-b--"`` → ``[a, b]``; ``"---"`` → ``[]``; ``""`` → ``[""]``.  ``sep``
    is a literal separator.
    """
    c = F.col(s) if isinstance(s, str) else s
    quoted = "\\Q" + sep + "\\E"
    stripped = F.regexp_replace(c, "(" + quoted + ")+$", "")
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, quoted))
    )


def lines_text(lines: Column | str = "lines") -> Column:
    """Set of line names as sorted, comma-separated text."""
    c = F.col(lines) if isinstance(lines, str) else lines
    return F.array_join(F.array_sort(c), ", ")
