"""Chat formatting: layouts are told by a schema fingerprint; DataFrame functions only.

The nested field paths that any known layout uses are looked for in a schema (or, for JSON
records, in each record); the hash of those present selects a declarative mapping to
canonical turns. Unknown extra fields don't matter.

The template writes each turn as `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and
texts a backslash is added to every run of backslashes between `<` and `|`, and a role's line
ends are written `\\n`, so no control string occurs there and reading back is exact. The loss
mask holds, per assistant turn, the span of its escaped text in the formatted string.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


@dataclass(frozen=True)
class Mapping:
    """Field paths of a layout (`[]`: items of an array) and SQL that makes its turns.

    `turns` gives an array of (role, text); a layout with a row per turn has none, but names
    its columns in `row` (conversation, turn, role, text).
    """

    name: str
    paths: tuple[str, ...]
    turns: str = ""
    row: tuple[str, ...] = ()

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


_PAIR = "array(named_struct('role', 'user', 'text', {0}), named_struct('role', 'assistant', 'text', {1}))"
_ROLES = "CASE m.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.from END"
_ASKED = "CASE WHEN coalesce(input, '') = '' THEN instruction ELSE concat_ws('\\n', instruction, input) END"

MAPPINGS = (
    Mapping("turn rows", ("conv_id", "turn", "role", "text"), row=("conv_id", "turn", "role", "text")),
    Mapping("messages", ("messages[].role", "messages[].content"), "transform(messages, m -> named_struct('role', m.role, 'text', m.content))"),
    Mapping("exchange", ("conversations[].from", "conversations[].value"), f"transform(conversations, m -> named_struct('role', {_ROLES}, 'text', m.value))"),
    Mapping("prompt and response", ("prompt", "response"), _PAIR.format("prompt", "response")),
    Mapping("prompt and completion", ("prompt", "completion"), _PAIR.format("prompt", "completion")),
    Mapping("instruction", ("instruction", "output"), _PAIR.format("instruction", "output")),
    Mapping("instruction with input", ("instruction", "input", "output"), _PAIR.format(_ASKED, "output")),
)
BY_SIZE = sorted(MAPPINGS, key=lambda m: -len(m.paths))
KNOWN = {path for m in MAPPINGS for path in m.paths}
RECORD = (
    "messages array<struct<role string, content string>>, conversations array<struct<`from` string, value string>>,"
    " prompt string, response string, completion string, instruction string, input string, output string"
)


def schema_paths(kind: T.DataType, before: str = "") -> set[str]:
    """Nested field paths of a type."""
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, before + "[]")
    if isinstance(kind, T.StructType):
        dot = f"{before}." if before else ""
        return {p for f in kind.fields for p in schema_paths(f.dataType, dot + f.name)}
    return {before}


def mapping_of(schema: T.StructType) -> Mapping:
    """The mapping for a table's schema; an unknown layout is an error.

    Of mappings whose fields are all there the one with most fields counts, then the first.
    """
    found = schema_paths(schema)
    for mapping in BY_SIZE:
        if fingerprint(found & set(mapping.paths)) == mapping.fingerprint:
            return mapping
    raise ValueError(f"no mapping for the fields {sorted(schema_paths(schema))}")


def canonical_turns(table: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """`conv_id`, `turn`, `role`, `text` of a table in any known layout; NULLs become empty."""
    mapping = mapping_of(table.schema)
    if mapping.row:
        key, turn, role, text = mapping.row
        rows = table.select(F.col(key).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    else:
        rows = _exploded(table.select(F.col(conv_id).alias("conv_id"), F.expr(mapping.turns).alias("turns")))
    return _filled(rows)


def _exploded(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", F.posexplode("turns").alias("turn", "t")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text"
    )


def _filled(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def turns_of_records(records: DataFrame, conv_id: str, payload: str) -> DataFrame:
    """Canonical turns of JSON records, each in a layout of its own.

    Every record's fingerprint, taken of a mapping's fields, selects that mapping; with several
    the one with most fields, then the first. `unknown_records` has what no mapping fits. A
    field that is null counts as absent, one in an array if it is null in every item.
    """
    read = _fingerprinted(records, conv_id, payload)
    turns = F.coalesce(*[F.when(F.col("print")[m.name] == m.fingerprint, F.expr(m.turns)) for m in BY_SIZE if m.turns])
    return _filled(_exploded(read.select("conv_id", turns.alias("turns")).where("turns IS NOT NULL")))


def unknown_records(records: DataFrame, conv_id: str, payload: str) -> DataFrame:
    """`conv_id` and fingerprint `print` of records that fit no mapping; malformed ones too."""
    read = _fingerprinted(records, conv_id, payload)
    fits = F.array(*[F.col("print")[m.name] == m.fingerprint for m in BY_SIZE if m.turns])
    return read.where(~F.array_contains(fits, True)).select("conv_id", F.col("print")["all"].alias("print"))


def _fingerprinted(records: DataFrame, conv_id: str, payload: str) -> DataFrame:
    read = records.select(
        F.col(conv_id).alias("conv_id"), F.from_json(payload, RECORD).alias("r")
    ).select("conv_id", "r.*")

    def there(path: str) -> Column:
        array, items, field = path.partition("[].")
        return F.exists(array, lambda item: item[field].isNotNull()) if items else F.col(path).isNotNull()

    def print_of(paths) -> Column:
        present = F.array_compact(F.array(*[F.when(there(p), F.lit(p)) for p in sorted(paths)]))
        return F.sha2(F.array_join(present, "\n").cast("binary"), 256)

    nested = [m for m in BY_SIZE if m.turns]
    every = print_of({p for m in nested for p in m.paths}).alias("all")
    return read.withColumn("print", F.struct(every, *[print_of(m.paths).alias(m.name) for m in nested]))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _role_out(role: Column) -> Column:
    slashes = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    return escaped(F.replace(slashes, F.lit("\n"), F.lit("\\n")))


def _role_in(role: Column) -> Column:
    marked = F.replace(unescaped(role), F.lit("\\\\"), F.lit("\\\x00"))
    return F.replace(F.replace(marked, F.lit("\\n"), F.lit("\n")), F.lit("\\\x00"), F.lit("\\"))


def formatted(turns: DataFrame) -> DataFrame:
    """`conv_id`, `formatted`, `loss` (spans `from`, `to` in code points) per conversation.

    Turns go by `turn` (NULL first), then role and text; equal rows all count. A NULL conv_id
    is a conversation like any other. Only the turns of one conversation meet in a task, as
    its string demands.
    """
    body = escaped(F.col("text"))
    head = F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n"))
    parts = turns.select(
        "conv_id", "turn", "role", "text", F.concat(head, body, F.lit(END + "\n")).alias("segment"),
        F.length(head).alias("skip"), F.length(body).alias("take"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.withColumn("end", F.sum(F.length("segment")).over(in_order)).withColumn(
        "pos", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    )
    start = F.col("end") - F.length("segment") + F.col("skip")
    span = F.when(F.col("role") == LEARNED_ROLE, F.struct(start.alias("from"), (start + F.col("take")).alias("to")))
    return placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "segment"))).alias("s"),
        F.sort_array(F.collect_list(span)).alias("loss"),
    ).select("conv_id", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("formatted"), "loss")


def read_back(chats: DataFrame) -> DataFrame:
    """`conv_id`, `pos`, `role`, `text`, `learned` (text under the loss mask, or NULL).

    Everything comes from the formatted string and its mask.
    """
    segments = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda _, at: at > 0)
    rows = chats.select("conv_id", F.posexplode(segments).alias("pos", "segment"))
    cut = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.length("segment") + len(START)).over(cut)).withColumn(
        "start", F.col("end") - F.length("segment") - len(START)
    )
    role = F.substring_index("segment", "\n", 1)
    body = F.substring("segment", F.length(role) + 2, F.length("segment"))
    text = F.substring_index(body, END, 1)
    masks = chats.select("conv_id", F.explode("loss").alias("m")).select(
        F.col("conv_id").alias("mask_id"), F.col("m.from").alias("from"), F.col("m.to").alias("to")
    )
    read = placed.select(
        "conv_id", "pos", "start", "segment", _role_in(role).alias("role"), unescaped(text).alias("text"),
        (F.col("start") + len(START) + F.length(role) + 1).alias("body_start"),
    )
    joined = read.join(
        masks, F.col("conv_id").eqNullSafe(F.col("mask_id")) & (F.col("body_start") == F.col("from")), "left"
    )
    under = F.substring("segment", F.col("from") - F.col("start") - len(START) + 1, F.col("to") - F.col("from"))
    return joined.select("conv_id", "pos", "role", "text", F.when(F.col("from").isNotNull(), unescaped(under)).alias("learned"))


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests of each conversation as read back from its formatted string."""
    turn = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    item = F.struct("pos", turn.alias("turn"), F.coalesce("learned", F.lit("")).alias("learned"))
    joined = lambda field: F.array_join(F.transform("s", lambda x: x[field]), "")
    read = (
        read_back(chats).groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("s"))
        .select("conv_id", F.size("s").cast("long").alias("n_turns"), joined("turn").alias("all"), joined("learned").alias("learned"))
        .select("conv_id", "n_turns", F.sha2(F.col("all").cast("binary"), 256).alias("turns_sha256"),
                F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"))
    )
    sizes = chats.select(F.col("conv_id").alias("size_id"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.join(sizes, F.col("conv_id").eqNullSafe(F.col("size_id"))).drop("size_id")
