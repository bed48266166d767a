"""From delimited text to typed, stamped raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopstar.functions import timestamp_lit
from shopstar.schemas import SourceTable

CORRUPT = "_corrupt"
# Separator and an absent quote character, so quotes are data.
DELIMITED = {"sep": ",", "quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def text_schema(table: SourceTable) -> StructType:
    """Every column as text, plus the raw line of a row with a wrong column count."""
    names = [*table.schema.fieldNames(), CORRUPT]
    return StructType([StructField(n, StringType()) for n in names])


def parse_lines(lines: DataFrame, line: str, table: SourceTable) -> DataFrame:
    """Split a column of delimited lines into text columns by position.

    Unpacked by a generator, which a later filter cannot be pushed through: every line
    is parsed once, not once per cell that a condition looks at.
    """
    layout = ", ".join(f"{name} STRING" for name in text_schema(table).fieldNames())
    return lines.select(F.inline(F.array(F.from_csv(line, layout, DELIMITED))))


def type_cells(text_rows: DataFrame, table: SourceTable) -> DataFrame:
    """Typed columns plus `bad_columns`: cells that do not fit their type or length.

    An empty cell is NULL, not a bad cell. A row with the wrong number of columns is
    reported under the name of the corrupt-line column.
    """
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in table.schema}
    misfits = {name: F.col(name).isNotNull() & cell.isNull() for name, cell in typed.items()}
    misfits |= {name: F.length(name) > limit for name, limit in table.lengths.items()}
    misfits[CORRUPT] = F.col(CORRUPT).isNotNull()
    bad = [F.when(misfit, F.lit(name)) for name, misfit in misfits.items()]
    return text_rows.select(
        *[cell.alias(name) for name, cell in typed.items()],
        F.array_compact(F.array(*bad)).alias("bad_columns"),
        F.col(CORRUPT),
    )


def accepted(typed: DataFrame) -> DataFrame:
    return typed.filter(F.size("bad_columns") == 0).drop("bad_columns", CORRUPT)


def rejected(typed: DataFrame) -> DataFrame:
    return typed.filter(F.size("bad_columns") > 0)


def by_outcome(typed: DataFrame, batch_id: str) -> DataFrame:
    """Sound and broken rows together, told apart by `accepted`.

    Broken rows carry their line, the columns at fault, and the batch that met them; sound
    ones have NULL there.
    """
    sound = F.size("bad_columns") == 0
    told = {"line": F.col(CORRUPT), "bad_columns": F.col("bad_columns"), "load_batch_id": F.lit(batch_id)}
    return typed.withColumns(
        {name: F.when(~sound, value) for name, value in told.items()} | {"accepted": sound}
    ).drop(CORRUPT)


def stamp(rows: DataFrame, batch_id: str, loaded_at) -> DataFrame:
    """Fill the audit columns where the file left the batch empty."""
    unstamped = F.col("batch_id").isNull()
    return rows.withColumns(
        {
            "load_date": F.when(unstamped, timestamp_lit(loaded_at)).otherwise(F.col("load_date")),
            "batch_id": F.coalesce("batch_id", F.lit(batch_id)),
        }
    )
