"""Feeds that arrive as text: lines are parsed one by one, and none is lost.

Every line is either a row of the feed or stands in the table of rejected lines, with
its file and the reason. Both come from one parse of each line. A JSON field that the
feed's columns do not name is kept as a new column, not dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas
from shoptrail.functions.variants import is_object, parsed, typed, typed_paths
from shoptrail.session import work_path

_BAD = "_rejected_line"
MALFORMED, MISSING, UNTYPED = "malformed line", "missing key", "wrong type"


@dataclass(frozen=True)
class Parsed:
    """A feed's rows, and the lines that are none: line, file, reason."""

    rows: DataFrame
    rejected: DataFrame


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines with the file they stand in."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")).filter("length(trim(line)) > 0")


def _split(lines: DataFrame, struct: Column, reason: Column, names: Sequence[str]) -> Parsed:
    """Parse once: what comes out is written to the work folder, and both tables read it."""
    done = lines.select("line", "file", struct.alias("row")).withColumn("reason", reason)
    path = work_path(lines.sparkSession, "parsed")
    done.write.parquet(path)
    done = lines.sparkSession.read.schema(done.schema).parquet(path)
    return Parsed(
        done.filter("reason is null").select(*[F.col("row")[n].alias(n) for n in names]),
        done.filter("reason is not null").select("line", "file", "reason"),
    )


def _missing(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for key in keys:
        out = out | F.col("row")[key].isNull()
    return out


def parse_separated(lines: DataFrame, fields: dict[str, str], keys: Sequence[str], separator: str = "\t") -> Parsed:
    """Lines of values in the order of ``fields``; empty values are NULL.

    Rejected: lines with more or fewer values or a value of the wrong type, and lines without one of ``keys``.
    """
    schema = f"{schemas.ddl(fields)}, {_BAD} string"
    options = {"sep": separator, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "enforceSchema": "true", "quote": "\u0000"}
    struct = F.from_csv(F.col("line"), schema, options)
    values = F.size(F.split("line", f"\\Q{separator}\\E", -1))
    bad = F.when(values != len(fields), MALFORMED).when(F.col("row")[_BAD].isNotNull(), UNTYPED).when(_missing(keys), MISSING)
    return _split(lines, struct, bad, list(fields))


def parse_json(lines: DataFrame, fields: dict[str, str], keys: Sequence[str], new_columns: bool = True) -> Parsed:
    """One JSON object a line. Fields not in ``fields`` become columns of the type found over all lines.

    Rejected: lines that are no JSON object or hold a value of the wrong type, and lines without one of ``keys``.
    """
    schema = f"{schemas.ddl(fields)}, {_BAD} string"
    struct = F.from_json(F.col("line"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    bad = F.when(~is_object(parsed("line")), MALFORMED).when(F.col("row")[_BAD].isNotNull(), UNTYPED).when(_missing(keys), MISSING)
    if not new_columns:
        return _split(lines, struct, bad, list(fields))
    held = lines.withColumn("_variant", parsed("line"))
    found = {n: kind for n, kind in typed_paths(held, "_variant").items() if n.lower() not in {f.lower() for f in fields}}
    more = typed("_variant", found)
    whole = F.struct(*[struct[n].alias(n) for n in (*fields, _BAD)], *more)
    return _split(held, whole, bad, [*fields, *found])
