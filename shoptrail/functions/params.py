"""Lookups in GA4's ``event_params`` key/value array (ARR-1, JOI-5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def param(params: str, key: str, strict: bool = False) -> Column:
    """The value struct of ``key``, NULL if the key is missing.

    A position search instead of a lambda over the array: it runs in generated
    code, and the scan reads no more of the value struct than is asked for. A
    repeated key gives its first value; ``strict`` fails on it instead.
    """
    first = F.expr(f"get({params}, cast(array_position({params}.key, '{key}') as int) - 1).value")
    if not strict:
        return first
    repeated = F.expr(f"size(filter({params}, p -> p.key = '{key}')) > 1")
    return F.when(repeated, F.raise_error(F.lit(f"repeated event parameter {key}"))).otherwise(first)


def param_text(params: str, key: str, strict: bool = False) -> Column:
    return param(params, key, strict)["string_value"]


def param_long(params: str, key: str, strict: bool = False) -> Column:
    return param(params, key, strict)["int_value"]


def param_number(params: str, key: str, strict: bool = False) -> Column:
    """A whole number sent either as a number or as text.

    Text that is no number gives NULL; ``strict`` reads the text value only
    and fails on such text.
    """
    if strict:
        return param_text(params, key, strict).cast("bigint")
    value = param(params, key)
    return F.coalesce(value["int_value"], value["string_value"].try_cast("bigint"))
