"""String cleaning expressions (JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Python ``str.strip()``: removes leading/trailing whitespace incl. tabs
    and newlines (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def title(x) -> Column:
    """Python ``str.title()`` for ASCII letters: every letter run starts upper
    case, the rest lower (``non-binary`` -> ``Non-Binary``, ``o'neil`` ->
    ``O'Neil``); ``initcap`` only capitalises after spaces."""
    runs = F.regexp_extract_all(_c(x), F.lit(r"([A-Za-z]+|[^A-Za-z]+)"), 1)
    return F.when(_c(x).isNull(), None).otherwise(
        F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)),
                                                          F.lower(F.substring(r, 2, 1 << 30)))), ""))


def strip_title(x) -> Column:
    return title(strip(x))


def normalise_name(name: str) -> str:
    """Column-name rule: lower case, spaces to underscores."""
    return name.lower().replace(" ", "_")
