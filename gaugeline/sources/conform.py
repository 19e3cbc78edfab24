"""From JSON text to typed rows, setting aside what does not fit the declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MAX_LENGTH, STREAM_READING, as_strings

_CORRUPT = "_corrupt"

# A date and a time, zero-padded. The cast alone would also take a time without a date, as of
# today, or a year alone: the same message would be another reading on another day.
_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?$"


def _cast(name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.when(F.col(name).rlike(_ISO), F.try_to_timestamp(F.col(name)))
    if isinstance(dtype, T.DoubleType):
        # "NaN" and "Infinity" are not JSON numbers, though the cast would take them.
        number = F.col(name).try_cast("double")
        return F.when(F.abs(number) < float("inf"), number)
    return F.col(name) if isinstance(dtype, T.StringType) else F.col(name).try_cast(dtype)


def typed(df: DataFrame, schema: T.StructType) -> tuple[dict[str, Column], Column]:
    """Casts of the text columns of ``df``, and the first reason to reject a row, if any.

    A required column must be present, convertible and within its length. An optional one that
    cannot be converted becomes NULL and the row stays.
    """
    casts = {f.name: _cast(f.name, f.dataType) for f in schema.fields}
    reasons = []
    for field in schema.fields:
        if not field.nullable:
            reasons.append(F.when(F.col(field.name).isNull(), F.lit(f"{field.name} missing")))
            if not isinstance(field.dataType, T.StringType):
                reasons.append(F.when(casts[field.name].isNull(), F.lit(f"{field.name} invalid")))
        if field.name in MAX_LENGTH:
            too_long = F.length(F.col(field.name)) > MAX_LENGTH[field.name]
            reasons.append(F.when(too_long, F.lit(f"{field.name} too long")))
    return casts, F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def parse(lines: DataFrame, schema: T.StructType = STREAM_READING) -> DataFrame:
    """Typed columns of the JSON objects in ``value``, with ``payload`` and ``reason``.

    Every field is first read as text: a typed JSON schema would flag the whole row for one bad
    field and lose the fields after it.
    """
    shape = as_strings(schema).add(_CORRUPT, T.StringType())
    message = F.from_json("value", shape, {"columnNameOfCorruptRecord": _CORRUPT})
    # A generator, so that filters on the fields stay above it: pushed into the scan's filter,
    # each field they name would parse the text once more.
    text = lines.select(F.col("value").alias("payload"), F.inline(F.array(message)))
    is_object = F.startswith(F.btrim("payload", F.lit(" \t\r\n")), F.lit("{"))

    casts, reason = typed(text, schema)
    broken = ~F.coalesce(is_object, F.lit(False)) | F.col(_CORRUPT).isNotNull()
    return text.select(
        *[c.alias(name) for name, c in casts.items()],
        "payload",
        F.when(broken, F.lit("not a JSON object")).otherwise(reason).alias("reason"),
    )


def split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = parsed.filter(F.col("reason").isNull()).drop("payload", "reason")
    bad = parsed.filter(F.col("reason").isNotNull()).select("reason", "payload")
    return good, bad


def conform(
    lines: DataFrame, schema: T.StructType = STREAM_READING
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: typed rows, and rejected payloads with the reason."""
    return split(parse(lines, schema))
