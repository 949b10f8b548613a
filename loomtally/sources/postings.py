"""Questions and answers from comma-separated lines without quoting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomtally.sources.strict import check_mode

QUESTION, ANSWER = 1, 2
COLUMNS = ("posting_type", "id", "accepted_answer", "parent_id", "score", "tags")
NUMBERS = COLUMNS[:5]
OPTIONAL = ("accepted_answer", "parent_id")


def _number(position: int, kind: str) -> str:
    """The integer a field spells, NULL if it spells none; surrounding space is not allowed.

    Empty fields are common and are set apart first: a failing cast is slow.
    """
    field = f"get(fields, {position})"
    spelled = f"{field} <> '' AND length({field}) = length(trim({field}))"
    return f"CASE WHEN {spelled} THEN try_cast({field} AS {kind}) END"


def parse_postings(
    lines: DataFrame, mode: str = "fail", line: str = "value", id_type: str = "int"
) -> DataFrame:
    """Posting columns of each line.

    Trailing empty fields count as absent and fields after the sixth are ignored.
    `accepted_answer` and `parent_id` may be empty; the other numbers may not, and text
    that is no integer is malformed. With `fail` a malformed field raises as soon as its
    column is read, with `drop` the whole line is left out. `id_type` is `int` or `bigint`.
    """
    check_mode(mode)
    kinds = [("int" if c in ("posting_type", "score") else id_type) for c in NUMBERS]
    numbers = [_number(i, kind) for i, kind in enumerate(kinds)]
    fields = F.expr(f"split(rtrim(',', `{line}`), ',')")
    if mode == "drop":
        valid = [
            f"(get(fields, {i}) = '' OR {numbers[i]} IS NOT NULL)" if name in OPTIONAL
            else f"{numbers[i]} IS NOT NULL"
            for i, name in enumerate(NUMBERS)
        ]
        # Exploding a single list keeps the filter from repeating the split per field.
        parsed = lines.select(F.explode(F.array(fields)).alias("fields"))
        return parsed.where(" AND ".join(valid)).selectExpr(
            *[f"{number} AS {name}" for number, name in zip(numbers, NUMBERS)],
            "get(fields, 5) AS tags",
        )
    columns = []
    for position, (name, kind) in enumerate(zip(NUMBERS, kinds)):
        complaint = f"raise_error(concat('malformed {name} in posting line: ', line))"
        checked = f"coalesce({numbers[position]}, cast({complaint} AS {kind}))"
        if name in OPTIONAL:
            checked = f"CASE WHEN get(fields, {position}) = '' THEN NULL ELSE {checked} END"
        columns.append(f"{checked} AS {name}")
    parsed = lines.select(F.coalesce(line, F.lit("NULL")).alias("line"), fields.alias("fields"))
    return parsed.selectExpr(*columns, "get(fields, 5) AS tags")


def read_postings(
    spark: SparkSession, path: str, mode: str = "fail", id_type: str = "int"
) -> DataFrame:
    return parse_postings(spark.read.text(path), mode, id_type=id_type)
