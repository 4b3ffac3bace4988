"""Chat formatting: layouts are told by a fingerprint of their field paths.

A fingerprint is the hash of the sorted nested field paths that any mapping
knows; other fields do not count. It selects a declarative mapping to turns of
role and text. Turns are then written with marks, as pieces that carry the loss
mask: assistant texts are under it.

Control strings inside texts are escaped, reversibly: ``&`` becomes ``&amp;``
and then ``<|`` becomes ``&lt;|``. In roles line breaks are escaped as well.

Defined cases: null texts and roles are empty. Turns are ordered by turn, null
last, then role and text; repeated rows are repeated turns. A null conversation
id is one conversation. A record of unknown layout has a null mapping and no
turns. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """Field paths of a layout, and the turns they hold.

    ``each`` names the path of a list with its role and text fields; ``fields``
    gives (role, path) in order, where an empty or missing one is left out.
    """

    name: str
    paths: tuple[str, ...]
    each: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()

    @property
    def fingerprint(self) -> str:
        return fingerprint_of(self.paths)


def fingerprint_of(paths) -> str:
    return hashlib.md5(",".join(sorted(paths)).encode()).hexdigest()


MAPPINGS = (
    Mapping("messages", ("messages[].role", "messages[].content"), each=("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), each=("conversations", "from", "value")),
    Mapping("prompt_response", ("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", ("prompt", "completion"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("system_prompt_response", ("system", "prompt", "response"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("question_answer", ("question", "answer"), fields=(("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", ("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", ("instruction", "input", "output"), fields=(("user", "instruction+input"), ("assistant", "output"))),
    Mapping("turn_rows", ("turn", "role", "text")),
)
# Names of roles in other layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}
KNOWN = frozenset(path for m in MAPPINGS for path in m.paths)


def schema_paths(schema: T.StructType, prefix: str = "") -> set[str]:
    """The nested field paths of a schema; ``[]`` stands for the elements of a list."""
    out: set[str] = set()
    for field in schema.fields:
        kind, path = field.dataType, prefix + field.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        out |= schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else {path}
    return out


def mapping_of(df: DataFrame) -> Mapping | None:
    """The mapping that a table's own columns select."""
    mark = fingerprint_of(schema_paths(df.schema) & KNOWN)
    return next((m for m in MAPPINGS if m.fingerprint == mark), None)


def _canonical(role: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    low = F.lower(F.trim(role))
    return F.coalesce(names[low], low, F.lit(""))


def _field_turns(mapping: Mapping, read) -> Column:
    parts = []
    for role, path in mapping.fields:
        text = F.concat_ws("\n", *[F.nullif(read(p), F.lit("")) for p in path.split("+")])
        parts.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
    return F.filter(F.array(*parts), lambda t: t["text"] != "").cast(TURNS)


def _listed_turns(items: Column, role: str, text: str) -> Column:
    turns = F.transform(items, lambda i: F.struct(_canonical(i[role]).alias("role"), F.coalesce(i[text], F.lit("")).alias("text")))
    return F.coalesce(turns, F.array().cast(TURNS)).cast(TURNS)


def turns_from_rows(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation from one row per turn. A conversation is one value of the result, so its turns meet."""
    turn = F.struct(
        F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = df.select(key, turn.alias("turn")).groupBy(key).agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return rows.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def turns_from_columns(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """The turns of a table whose columns are one known layout."""
    mapping = mapping_of(df)
    if mapping is None:
        raise ValueError(f"no mapping knows these fields: {sorted(schema_paths(df.schema))}")
    if mapping.name == "turn_rows":
        return turns_from_rows(df, key)
    if mapping.each:
        items, role, text = mapping.each
        return df.select(key, _listed_turns(F.col(items), role, text).alias("turns"))
    return df.select(key, _field_turns(mapping, F.col).alias("turns"))


def json_paths(record: Column) -> Column:
    """The known field paths of each JSON record, sorted."""
    fields = F.map_entries(F.coalesce(F.from_json(record, "map<string,string>"), F.create_map().cast("map<string,string>")))

    def paths(entry: Column) -> Column:
        inside = F.from_json(entry["value"], "array<map<string,string>>")
        keys = F.map_keys(F.coalesce(inside[0], F.create_map().cast("map<string,string>")))
        nested = F.transform(keys, lambda k: F.concat(entry["key"], F.lit("[]."), k))
        return F.when(entry["value"].startswith("["), nested).otherwise(F.array(entry["key"]))

    found = F.flatten(F.transform(fields, paths))
    return F.sort_array(F.filter(found, lambda p: p.isin(*sorted(KNOWN))))


def turns_from_json(df: DataFrame, record: str, key: str = "conv_id") -> DataFrame:
    """The turns of JSON records of mixed layouts, each told by its own fingerprint."""
    rows = df.select(key, F.col(record).alias("record")).withColumn("fingerprint", F.md5(F.array_join(json_paths(F.col("record")), ",")))
    turns, name = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    for m in (m for m in MAPPINGS if m.name != "turn_rows"):
        if m.each:
            items, role, text = m.each
            found = _listed_turns(F.from_json(F.get_json_object("record", f"$.{items}"), f"array<struct<`{role}`:string,`{text}`:string>>"), role, text)
        else:
            found = _field_turns(m, lambda p: F.get_json_object("record", f"$.{p}"))
        here = F.col("fingerprint") == m.fingerprint
        turns, name = F.when(here, found).otherwise(turns), F.when(here, F.lit(m.name)).otherwise(name)
    return rows.select(key, name.alias("mapping"), F.coalesce(turns, F.array().cast(TURNS)).alias("turns"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def format_turns(turns: DataFrame, train_on: str = "assistant") -> DataFrame:
    """Add ``pieces`` (text and loss, in order) and ``formatted``, their concatenation."""
    def pieces(turn: Column) -> Column:
        role = F.replace(escape(turn["role"]), F.lit("\n"), F.lit("&#10;"))
        return F.array(
            F.struct(F.concat(F.lit(OPEN), role, F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), (turn["role"] == train_on).alias("loss")),
            F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
        )

    out = turns.withColumn("pieces", F.flatten(F.transform("turns", pieces)))
    return out.withColumn("formatted", F.array_join(F.transform("pieces", lambda p: p["text"]), ""))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)
    return F.transform(parts, _parse_turn)


def _parse_turn(part: Column) -> Column:
    role = F.substring_index(part, "\n", 1)
    text = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - F.lit(len(CLOSE)))
    return F.struct(unescape(F.replace(role, F.lit("&#10;"), F.lit("\n"))).alias("role"), unescape(text).alias("text"))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")
