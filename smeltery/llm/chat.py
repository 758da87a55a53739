"""Chat records of any layout as canonical turns, and turns as one training text.

A *schema fingerprint* is the hash of sorted nested field paths. A layout fits a table's schema, or a
JSON record, whose fingerprint over the layout's own paths is the layout's: extra fields, of whatever
name, do not matter. The layout found is a declarative mapping to turns of role and text.

The template is ``### role: text</turn>`` and a line feed for each turn. Control strings inside
roles and texts are escaped with a backslash and a letter, so that a text never forges a mark and
reading back restores every character. The loss mask says for each turn how many characters to
skip and how many of the following to train on.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"
START, SEPARATOR, END = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"
# The backslash goes first when escaping and last when restoring.
TEXT_ESCAPES = (("\\", "\\b"), ("### ", "\\h"), ("</turn>", "\\e"))
ROLE_ESCAPES = (*TEXT_ESCAPES, (":", "\\c"))


@dataclass(frozen=True)
class Layout:
    """How one layout becomes turns.

    ``fields`` maps a role to the fields whose texts, joined by a blank line, it says. ``each`` names
    an array and its role and text fields. ``rows`` names the record, order, role and text columns of
    a table with one row for each turn.
    """

    name: str
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: tuple[str, str, str] | None = None
    rows: tuple[str, str, str, str] | None = None

    def paths(self) -> tuple[str, ...]:
        if self.rows:
            return tuple(sorted(self.rows))
        if self.each:
            array, role, text = self.each
            return tuple(sorted((f"{array}[].{role}", f"{array}[].{text}")))
        return tuple(sorted(f for _, names in self.fields for f in names))

    def fingerprint(self) -> str:
        return fingerprint(self.paths())


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


LAYOUTS = (
    Layout("turn rows", rows=("conv_id", "turn", "role", "text")),
    Layout("messages", each=("messages", "role", "content")),
    Layout("shared conversation", each=("conversations", "from", "value")),
    Layout("prompt and response", (("user", ("prompt",)), (ASSISTANT, ("response",)))),
    Layout("prompt and completion", (("user", ("prompt",)), (ASSISTANT, ("completion",)))),
    Layout("question and answer", (("user", ("question",)), (ASSISTANT, ("answer",)))),
    Layout("instruction", (("user", ("instruction",)), (ASSISTANT, ("output",)))),
    Layout("instruction with input", (("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    Layout(
        "system, prompt and response",
        (("system", ("system",)), ("user", ("prompt",)), (ASSISTANT, ("response",))),
    ),
)
KNOWN_PATHS = frozenset(p for layout in LAYOUTS for p in layout.paths())
# A record that has the fields of several layouts takes the one with the most.
BY_SIZE = tuple(sorted(LAYOUTS, key=lambda layout: -len(layout.paths())))
# Other names of the same roles.
ROLE_NAMES = {"human": "user", "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}


def field_paths(kind: T.DataType, prefix: str = "") -> Iterator[str]:
    """Paths of all leaves; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from field_paths(field.dataType, f"{prefix}.{field.name}" if prefix else field.name)
    elif isinstance(kind, T.ArrayType):
        yield from field_paths(kind.elementType, f"{prefix}[]")
    else:
        yield prefix


def layout_of(schema: T.StructType) -> Layout:
    """The layout of a table; an unknown one is an error that names its paths."""
    paths = set(field_paths(schema))
    for layout in BY_SIZE:
        if fingerprint(paths.intersection(layout.paths())) == layout.fingerprint():
            return layout
    raise ValueError(f"no layout for the fields {sorted(paths)}")


def _turn(role: Column, text: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    role = F.coalesce(role.cast("string"), F.lit(""))
    return F.struct(
        F.coalesce(names[role], role).alias("role"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    )


def _turns(layout: Layout, field) -> Column:
    """Turns of one record; ``field`` gives the column of a field."""
    if layout.each:
        array, role, text = layout.each
        turns = F.transform(field(array), lambda m: _turn(m[role], m[text]))
        return F.coalesce(turns, F.array().cast(TURNS))
    said = []
    for role, names in layout.fields:
        texts = F.filter(F.array(*[field(n).cast("string") for n in names]), lambda x: x != "")
        said.append(_turn(F.lit(role), F.array_join(texts, "\n\n")))
    return F.array(*said)


def canonical_turns(df: DataFrame) -> DataFrame:
    """Turns of a table whose schema is one of the layouts.

    Turn rows become one row for each ``conv_id`` (null is one too), ordered by turn (null first),
    role and text; repeated rows stay. Other layouts keep their rows and columns and get ``turns``.
    Null texts and roles are empty; a null array has no turns.
    """
    layout = layout_of(df.schema)
    if not layout.rows:
        return df.withColumn("turns", _turns(layout, lambda name: F.col(f"`{name}`")))
    record, order, role, text = (F.col(f"`{n}`") for n in layout.rows)
    parts = F.struct(order.alias("o"), _turn(role, text).alias("t"))
    grouped = df.groupBy(record.alias(layout.rows[0])).agg(F.sort_array(F.collect_list(parts)).alias("parts"))
    return grouped.select(layout.rows[0], F.transform("parts", lambda p: p["t"]).alias("turns"))


def _inner_paths(record: Column, array: str) -> Column:
    """Paths below the first element of an array in a JSON record."""
    first = F.json_object_keys(F.get_json_object(record, f"$.{array}[0]"))
    paths = F.transform(first, lambda key: F.concat(F.lit(f"{array}[]."), key))
    return F.coalesce(paths, F.array().cast("array<string>"))


def canonical_json(df: DataFrame, record: str) -> DataFrame:
    """``df`` with ``schema_fingerprint`` and ``turns`` of JSON records of mixed layouts.

    Records of no known layout, invalid ones and nulls keep their row with null turns.
    """
    value = F.col(f"`{record}`")
    parts = [F.coalesce(F.json_object_keys(value), F.array().cast("array<string>"))]
    for layout in LAYOUTS:
        if layout.each:
            parts.append(_inner_paths(value, layout.each[0]))
    known = F.array(*[F.lit(p) for p in sorted(KNOWN_PATHS)])
    paths = F.array_sort(F.array_intersect(F.array_distinct(F.concat(*parts)), known))
    df = df.withColumn("schema_fingerprint", F.sha2(F.array_join(paths, "\n"), 256))
    turns = F.lit(None).cast(TURNS)
    for layout in reversed(BY_SIZE):  # the last condition is asked first
        if layout.rows:
            continue
        schema = (
            "{0} array<struct<`{1}`:string,`{2}`:string>>".format(*layout.each)
            if layout.each
            else ", ".join(f"`{p}` string" for p in layout.paths())
        )
        parsed = F.from_json(value, schema)
        own = F.array_intersect(paths, F.array(*[F.lit(p) for p in layout.paths()]))
        matches = F.sha2(F.array_join(own, "\n"), 256) == layout.fingerprint()
        turns = F.when(matches, _turns(layout, parsed.getItem)).otherwise(turns)
    return df.withColumn("turns", turns)


def escaped(text: Column, escapes=TEXT_ESCAPES) -> Column:
    for plain, mark in escapes:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def restored(text: Column, escapes=TEXT_ESCAPES) -> Column:
    for plain, mark in reversed(escapes):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def formatted(df: DataFrame) -> DataFrame:
    """``df`` with ``formatted`` and ``loss_mask`` (array of skip, take; one for each turn) of ``turns``.

    ``skip`` counts from the end of the turn before. Only assistant texts are taken.
    """

    def header(t: Column) -> Column:
        return F.concat(F.lit(START), escaped(t["role"], ROLE_ESCAPES), F.lit(SEPARATOR))

    def mask(t: Column) -> Column:
        take = F.when(t["role"] == ASSISTANT, F.length(escaped(t["text"]))).otherwise(0)
        return F.struct(F.length(header(t)).alias("skip"), take.alias("take"))

    chunks = F.transform("turns", lambda t: F.concat(header(t), escaped(t["text"]), F.lit(END)))
    return df.withColumns(
        {"formatted": F.array_join(chunks, ""), "loss_mask": F.transform("turns", mask)}
    )


def _chunks(text: Column) -> Column:
    parts = F.split(text, END, -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def read_back(text: Column) -> Column:
    """Turns of a formatted text."""

    def turn(chunk: Column) -> Column:
        rest = F.substring(chunk, F.lit(len(START) + 1), F.length(chunk))
        role = F.substring_index(rest, SEPARATOR, 1)
        said = F.substring(rest, F.length(role) + len(SEPARATOR) + 1, F.length(rest))
        return F.struct(restored(role, ROLE_ESCAPES).alias("role"), restored(said).alias("text"))

    return F.transform(_chunks(text), turn)


def under_mask(text: Column, mask: Column) -> Column:
    """All characters of a formatted text under its loss mask, unescaped, nothing between."""
    taken = F.zip_with(
        _chunks(text), mask, lambda chunk, m: restored(F.substring(chunk, m["skip"] + 1, m["take"]))
    )
    return F.array_join(taken, "")
