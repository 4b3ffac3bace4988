"""Text expressions: URLs, labels, flags and category clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, defaults and sentinels of the published model.
PATH_PATTERN = r"https?://[^/]+(/[^?#]*)"
HOST_PATTERN = r"https?://([^/]+)"
STRICT_PATH_PATTERN = r"https?://[^/?#]+(/[^?#]*)"
STRICT_HOST_PATTERN = r"https?://([^/?#]+)"
QUERY_PATTERN = r"\?([^\n]*)"
DIRECT = "(direct)"
NO_MEDIUM = "(none)"
NOT_SET = "(not set)"
UNCATEGORIZED = "Uncategorized"


def url_path(url: Column, strict: bool = False) -> Column:
    """The path of an absolute URL, NULL without one (SCA-10).

    A match is never empty, so the empty text Spark gives for "no match" can
    be turned to NULL without running the pattern twice.
    """
    return F.nullif(F.regexp_extract(url, STRICT_PATH_PATTERN if strict else PATH_PATTERN, 1), F.lit(""))


def url_host(url: Column, strict: bool = False) -> Column:
    """The host of an absolute URL, NULL without one (SCA-11)."""
    return F.nullif(F.regexp_extract(url, STRICT_HOST_PATTERN if strict else HOST_PATTERN, 1), F.lit(""))


def url_query(url: Column) -> Column:
    """Everything behind the first ``?``; empty behind a trailing one (SCA-12)."""
    return F.when(F.instr(url, "?") > 0, F.regexp_extract(url, QUERY_PATTERN, 1))


def source_medium(source: str = "traffic_source_source", medium: str = "traffic_source_medium") -> Column:
    """The ``source / medium`` label (SCA-25)."""
    return F.concat(
        F.coalesce(F.col(source), F.lit(DIRECT)), F.lit(" / "), F.coalesce(F.col(medium), F.lit(NO_MEDIUM))
    )


def mobile_flag(device_type: str = "device_type") -> Column:
    """True for mobile, False for desktop, NULL for everything else (SCA-18)."""
    kind = F.lower(F.col(device_type))
    return F.when(kind == "mobile", True).when(kind == "desktop", False)


def text_flag(column: str) -> Column:
    """``'1'`` is true, everything else false, NULL too (SCA-19)."""
    return F.coalesce(F.col(column) == "1", F.lit(False))


def category_levels(prefix: str = "item_category") -> list[Column]:
    """The five cleaned category levels (SCA-15, SCA-17)."""
    first = F.coalesce(F.col(prefix), F.lit(UNCATEGORIZED)).alias("category_l1")
    rest = [F.nullif(F.col(f"{prefix}{n}"), F.lit(NOT_SET)).alias(f"category_l{n}") for n in range(2, 6)]
    return [first, *rest]
