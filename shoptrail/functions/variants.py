"""Free-form JSON properties as typed columns (VARIANT)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Types a path is read as; any other, or several types on one path, are read as text.
_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "STRING": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp"}


def parsed(text: str | Column) -> Column:
    """The text as VARIANT; NULL if it is no JSON, which ``broken`` tells from a missing text."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def broken(text: str, variant: str) -> Column:
    return F.col(text).isNotNull() & F.col(variant).isNull()


def is_object(variant: str | Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(variant), F.lit("OBJECT")), F.lit(False))


def _fields(schema: str) -> dict[str, str]:
    """The top fields of ``OBJECT<name: TYPE, ...>``."""
    found = re.fullmatch(r"OBJECT<(.*)>", schema or "", re.DOTALL)
    fields, depth, part, quoted = {}, 0, "", False
    for c in (found.group(1) if found else "") + ",":
        quoted ^= c == "`"
        depth += (c in "<(") - (c in ">)") if not quoted else 0
        if c == "," and depth == 0 and not quoted:
            if ": " in part:
                name, kind = part.strip().rsplit(": ", 1) if "<" not in part else part.strip().split(": ", 1)
                fields[name.strip("`")] = kind
            part = ""
        else:
            part += c
    return fields


def typed_paths(df: DataFrame, variant: str) -> dict[str, str]:
    """The top fields of all of a table's objects and the Spark type to read each as.

    One aggregate over the table, combined before its shuffle; the driver gets one line of text.
    Whole numbers and fractions on one path are ``double``; other mixtures and nested values ``string``.
    """
    # Lists and single values have no fields; with them all of the schema would be one VARIANT.
    schema = df.agg(F.schema_of_variant_agg(F.when(is_object(variant), F.col(variant))).alias("s")).first()["s"]
    types = {}
    for name, kind in _fields(schema).items():
        decimal = re.fullmatch(r"DECIMAL\(\d+,\s*(\d+)\)", kind)
        types[name] = "double" if decimal else _TYPES.get(kind, "string")
    return dict(sorted(types.items()))


def typed(variant: str, types: dict[str, str], prefix: str = "") -> list[Column]:
    """A column for each field, NULL where it is missing, JSON null, or cannot be read as its type. Nested values are their JSON."""
    return [F.try_variant_get(F.col(variant), f'$["{name}"]', kind).alias(f"{prefix}{name}") for name, kind in types.items() if '"' not in name]
