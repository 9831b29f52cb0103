"""Chat formatting by schema fingerprint, with DataFrame functions only.

Records of any nested layout carry a fingerprint: the hash of the field paths
that are present in them. A registry of declarative mappings, keyed by such
fingerprints, turns each layout into canonical (role, text) turns, which one
template then renders. Control characters of the template never occur inside
rendered texts, so splitting at the control strings reads the turns back.

Defined results: null text and null role are empty; a record whose fingerprint
no mapping knows keeps its row, with layout and formatted text null; an empty
list of turns formats to empty text; turns with equal numbers are ordered by
role, then text; a null conversation id is a conversation of its own; repeated
rows are repeated turns. All turns of one conversation form one string, so one
conversation is one row by definition.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
OPEN, MIDDLE, CLOSE = "### ", ":\n", "</turn>\n"
#: Each escape begins with a backslash; none holds a control character.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))


def leaf_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Paths of the leaves, arrays marked by []."""
    if isinstance(schema, T.StructType):
        return [p for f in schema for p in leaf_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(schema, T.ArrayType):
        return leaf_paths(schema.elementType, f"{prefix}[]")
    return [prefix]


def _present(value: Column, schema: T.DataType, prefix: str) -> list[Column]:
    """For each leaf its path where it holds a value, else null. Inside of an
    array a leaf is present if any element holds it, at any depth."""
    return [F.when(held(value), F.lit(path)) for path, held in zip(leaf_paths(schema, prefix), _tests(schema), strict=True)]


def _tests(schema: T.DataType) -> list:
    """For each leaf, in the order of leaf_paths, whether a value holds it."""
    if isinstance(schema, T.StructType):
        return [_in_field(f.name, held) for f in schema for held in _tests(f.dataType)]
    if isinstance(schema, T.ArrayType):
        return [_in_array(held) for held in _tests(schema.elementType)]
    return [lambda value: value.isNotNull()]


def _in_field(name: str, held):
    return lambda value: held(value[name])


def _in_array(held):
    return lambda value: F.coalesce(F.exists(value, lambda x: held(x)), F.lit(False))


def fingerprint(record: Column, schema: T.StructType) -> Column:
    """Hash of the sorted paths of the fields that hold a value."""
    return F.sha2(F.array_join(F.array_sort(F.array_compact(F.array(*_present(record, schema, "")))), ","), 256)


def fingerprint_of(paths: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(paths)).encode()).hexdigest()


@dataclass(frozen=True)
class Mapping:
    """Layout: its required and optional paths, and its turns. ``turns`` lists
    (role, path) pairs, or one (role path, text path) pair within ``each``."""

    name: str
    required: tuple[str, ...]
    turns: tuple[tuple[str, str], ...]
    optional: tuple[str, ...] = ()
    each: str | None = None

    def fingerprints(self) -> list[str]:
        subsets = (c for n in range(len(self.optional) + 1) for c in combinations(self.optional, n))
        return [fingerprint_of([*self.required, *extra]) for extra in subsets]

    def apply(self, record: Column) -> Column:
        if self.each:
            role, text = self.turns[0]
            turns = F.transform(record[self.each], lambda m: F.struct(m[role].cast("string").alias("role"), m[text].cast("string").alias("text")))
        else:
            turns = F.array(*[F.when(_at(record, path).isNotNull(), F.struct(F.lit(role).alias("role"), _at(record, path).cast("string").alias("text"))) for role, path in self.turns])
            turns = F.array_compact(turns)
        return turns.cast(TURNS)


def _at(record: Column, path: str) -> Column:
    for name in path.split("."):
        record = record[name]
    return record


REGISTRY = (
    Mapping("messages", (), (("role", "content"),), ("messages[].role", "messages[].content"), "messages"),
    Mapping("conversations", ("conversations[].from",), (("from", "value"),), ("conversations[].value",), "conversations"),
    Mapping("prompt", ("prompt", "completion"), (("system", "system"), ("user", "prompt"), ("assistant", "completion")), ("system",)),
    Mapping("instruction", ("instruction", "output"), (("user", "instruction"), ("user", "input"), ("assistant", "output")), ("input",)),
    Mapping("qa", ("data.question", "data.answer"), (("user", "data.question"), ("assistant", "data.answer"))),
)


def canonical_turns(records: DataFrame, record: str = "record", registry=REGISTRY) -> DataFrame:
    """Adds fingerprint, layout and turns. Mappings to fields that the records'
    schema lacks can't match and are left out."""
    schema = records.schema[record].dataType
    paths = set(leaf_paths(schema))
    value = F.col(record)
    known = []
    for m in registry:
        needed = [f"{m.each}[].{p}" for p in m.turns[0]] if m.each else [p for _, p in m.turns]
        if m.required and not set(m.required) <= paths or m.each and not set(needed) <= paths:
            continue
        turns = m if m.each else Mapping(m.name, m.required, tuple(t for t in m.turns if t[1] in paths), m.optional)
        known.append((m, turns.apply(value)))
    mark = F.col("fingerprint")
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m, made in reversed(known):
        layout = F.when(mark.isin(m.fingerprints()), F.lit(m.name)).otherwise(layout)
        turns = F.when(F.col("layout") == m.name, made).otherwise(turns)
    return records.withColumn("fingerprint", fingerprint(value, schema)).withColumn("layout", layout).withColumn("turns", turns)


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def render(turns: Column, trained: str = "assistant") -> Column:
    """Segments (text, loss): the turn's opening, its text and its closing."""

    def turn(t):
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        role = escape(F.coalesce(t["role"], F.lit("")))
        return F.array(
            part(F.concat(F.lit(OPEN), role, F.lit(MIDDLE)), F.lit(False)),
            part(escape(F.coalesce(t["text"], F.lit(""))), F.coalesce(t["role"] == trained, F.lit(False))),
            part(F.lit(CLOSE), F.lit(False)),
        )

    return F.flatten(F.transform(turns, turn))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation. Control strings cannot occur in a
    text, so plain splitting is exact."""
    pieces = F.slice(F.split(formatted, CLOSE), F.lit(1), F.size(F.split(formatted, CLOSE)) - 1)

    def turn(p):
        cut = F.instr(p, MIDDLE)
        return F.struct(
            unescape(F.substring(p, F.lit(len(OPEN) + 1), cut - F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substring(p, cut + F.lit(len(MIDDLE)), F.char_length(p))).alias("text"),
        )

    return F.transform(pieces, turn)


def format_chat(records: DataFrame, record: str = "record", registry=REGISTRY) -> DataFrame:
    """Adds fingerprint, layout, turns, segments with their loss mask, and the
    formatted text."""
    out = canonical_turns(records, record, registry).withColumn("segments", render(F.col("turns")))
    return out.withColumn("formatted", F.when(F.col("segments").isNotNull(), F.array_join(F.col("segments.text"), "")))


def as_records(rows: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """One record per conversation in the layouts found in practice: a user's
    and an assistant's turn as prompt and completion (or instruction and
    output, by the id), any other as a list of messages."""
    item = F.struct(F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    grouped = rows.select(F.col(conv_id).alias("conv_id"), item.alias("item")).groupBy("conv_id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    first, second = F.get("items", F.lit(0)), F.get("items", F.lit(1))
    pair = (F.size("items") == 2) & (first["role"] == "user") & (second["role"] == "assistant")
    kind = F.coalesce(F.pmod(F.col("conv_id"), F.lit(3)), F.lit(0))
    either = lambda test, value: F.when(test, value)
    listed = lambda a, b: F.transform("items", lambda x: F.struct(x["role"].alias(a), x["text"].alias(b)))
    return grouped.select(
        "conv_id",
        F.struct(
            either(pair & (kind == 0), first["text"]).alias("prompt"),
            either(pair & (kind == 0), second["text"]).alias("completion"),
            either(pair & (kind == 1), first["text"]).alias("instruction"),
            either(pair & (kind == 1), second["text"]).alias("output"),
            either(pair & (kind == 2), F.struct(first["text"].alias("question"), second["text"].alias("answer"))).alias("data"),
            either(~pair & (kind == 0), listed("from", "value")).alias("conversations"),
            either(~pair & (kind != 0), listed("role", "content")).alias("messages"),
        ).alias("record"),
    )


def chat_digest(rows: DataFrame) -> DataFrame:
    """The contract's columns, read back from the formatted text and mask."""
    made = format_chat(as_records(rows)).select("conv_id", "layout", "formatted", "segments")
    made = made.withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "loss", F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )
