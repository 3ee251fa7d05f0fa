"""Fixed-width records described by a layout table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.functions.scalar import strict_double, strict_int
from tallyforge.sources.parsed import Parsed, split_by_reason


class Field(NamedTuple):
    name: str
    start: int  # 0-based, inclusive
    end: int  # exclusive
    kind: str  # "int" or "double"
    scale: int = 1

    def text(self) -> Column:
        return F.substring("value", self.start + 1, self.end - self.start)

    def number(self, text: Column) -> Column:
        return strict_int(text) if self.kind == "int" else strict_double(text)

    def value(self, number: Column) -> Column:
        scaled = number.cast("double")
        return scaled if self.scale == 1 else scaled / F.lit(float(self.scale))


# The column positions of the surface-observation record format.
WEATHER_LAYOUT = (
    Field("year", 15, 19, "int"),
    Field("month", 19, 21, "int"),
    Field("day", 21, 23, "int"),
    Field("hour", 23, 25, "int"),
    Field("latitude", 28, 34, "double", 1000),
    Field("longitude", 34, 41, "double", 1000),
    Field("elevationDimension", 46, 51, "int"),
    Field("directionAngle", 60, 63, "int"),
    Field("speedRate", 65, 69, "double", 10),
    Field("ceilingHeightDimension", 70, 75, "int"),
    Field("distanceDimension", 78, 84, "int"),
    Field("dewPointTemperature", 93, 98, "double", 10),
    Field("airTemperature", 87, 92, "double", 10),
)

# Text that marks a missing target; such records are left out.
WEATHER_MISSING = {"airTemperature": "+9999"}


def parse_fixed_width(
    lines: DataFrame,
    layout: tuple[Field, ...] = WEATHER_LAYOUT,
    missing: dict[str, str] | None = None,
    null_codes: dict[str, str] | None = None,
    on_error: str = "drop",
) -> Parsed:
    """Parse a ``value`` column of records into double columns.

    Records whose field holds its ``missing`` text are left out and are no
    rejects.  ``null_codes`` optionally turns a field's code into NULL; by
    default such codes stay numbers.  Extra columns of ``lines`` are carried.
    """
    missing = WEATHER_MISSING if missing is None else missing
    null_codes = null_codes or {}
    by_name = {f.name: f for f in layout}
    present = lines.filter(F.col("value").isNotNull())
    for name, text in missing.items():
        present = present.filter(by_name[name].text() != text)

    texts, numbers = ({f.name: f"_{kind}_{f.name}" for f in layout} for kind in ("text", "number"))
    cut = present.withColumns({texts[f.name]: f.text() for f in layout})
    cut = cut.withColumns({numbers[f.name]: f.number(F.col(texts[f.name])) for f in layout})
    width = max(f.end for f in layout)
    reason = F.when(F.length("value") < width, F.lit("short"))
    for f in layout:
        reason = reason.when(F.col(numbers[f.name]).isNull(), F.lit(f"bad {f.name}"))

    def field_value(f: Field) -> Column:
        code, value = null_codes.get(f.name), f.value(F.col(numbers[f.name]))
        return value if code is None else F.when(F.col(texts[f.name]) != code, value)

    fields = {f.name: field_value(f) for f in layout}
    return split_by_reason(cut, reason, fields, on_error, (*texts.values(), *numbers.values()))


def read_fixed_width(spark: SparkSession, path: str | list[str], **options) -> Parsed:
    """Read records from files or a glob; ``.gz`` files work, one task each."""
    return parse_fixed_width(spark.read.text(path), **options)
