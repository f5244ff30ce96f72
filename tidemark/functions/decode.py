"""Messages to typed records.

A bad message never fails the job and never turns into invented data: it becomes
a row with ``is_valid = false`` and null fields, which :func:`accepted` and
:func:`rejected` separate.  :func:`strict_json` is the opposite contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas

COMMAND_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

_INTEGER_TEXT = "^[+-]?[0-9]+$"


def _integer(text: Column, data_type: str) -> Column:
    return F.when(text.rlike(_INTEGER_TEXT), text.try_cast(data_type))


def _pinned(parsed: Column) -> Column:
    """A parse that is evaluated once per message.

    Catalyst copies a parse into every filter on its fields.  It moves no filter
    below a generator, so the parse becomes the one row of one.
    """
    return F.explode(F.array(parsed))


def _csv_field(parts: Column, field: T.StructField, position: int) -> Column:
    text = F.get(parts, F.lit(position))
    if isinstance(field.dataType, T.StringType):
        return text
    return _integer(text, field.dataType.simpleString())


def decode_csv(
    df: DataFrame, schema: T.StructType, value: str = "value", exact_arity: bool = False
) -> DataFrame:
    """Comma-separated text to the fields of ``schema`` plus ``is_valid``.

    Trailing empty fields do not count.  Without ``exact_arity`` surplus fields
    are ignored; with it the number of fields has to match the schema.
    """
    names = schema.fieldNames()
    width = len(names)
    parts = F.split(F.regexp_replace(F.col(value), ",+$", ""), ",")
    found = F.size("_parts")
    arity = found == width if exact_arity else found >= width
    staged = df.withColumn("_parts", _pinned(parts))
    fields = {
        field.name: _csv_field(F.col("_parts"), field, i)
        for i, field in enumerate(schema.fields)
    }
    typed = staged.withColumns(fields)
    complete = F.coalesce(arity, F.lit(False))
    for name in names:
        complete = complete & F.col(name).isNotNull()
    flagged = typed.withColumn("is_valid", complete).drop("_parts")
    return flagged.withColumns(
        {name: F.when(F.col("is_valid"), F.col(name)) for name in names}
    )


def decode_csv_rate(df: DataFrame, value: str = "value") -> DataFrame:
    return decode_csv(df, schemas.RATE, value)


def decode_csv_order(df: DataFrame, value: str = "value") -> DataFrame:
    return decode_csv(df, schemas.ORDER, value, exact_arity=True)


def decode_json(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    required: tuple[str, ...] | None = None,
) -> DataFrame:
    """JSON text to the fields of ``schema`` plus ``is_valid``.

    ``required`` names the fields that must be present (default: all of them).
    """
    names = schema.fieldNames()
    needed = names if required is None else list(required)
    parsed = df.withColumn("_message", _pinned(F.from_json(F.col(value), schema)))
    complete = F.col("_message").isNotNull()
    for name in needed:
        complete = complete & F.col(f"_message.{name}").isNotNull()
    parsed = parsed.withColumn("is_valid", complete)
    return parsed.withColumns(
        {name: F.when(F.col("is_valid"), F.col(f"_message.{name}")) for name in names}
    ).drop("_message")


def decode_json_rate(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON rate messages to ``ts, hbdm, num``."""
    return decode_json(df, schemas.RATE_MESSAGE, value).withColumnRenamed("timestamp", "ts")


def command_time(text: Column | str) -> Column:
    """Event time of a command log record, null when the text is no such time."""
    column = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(column, F.lit(COMMAND_TIME_FORMAT))


def decode_command_log(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON command log messages plus ``et``; unknown type names are invalid."""
    decoded = decode_json(
        df, schemas.COMMAND_LOG, value, required=("ts", "type", "serialnumber")
    ).withColumn("et", command_time("ts"))
    known = F.col("type").isin(*schemas.LOG_TYPES) & (
        F.col("command_type").isNull() | F.col("command_type").isin(*schemas.COMMAND_TYPES)
    )
    return decoded.withColumn(
        "is_valid", F.col("is_valid") & F.coalesce(known, F.lit(False)) & F.col("et").isNotNull()
    )


def strict_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The declared fields of JSON messages; a bad or incomplete one fails the job."""
    parsed = F.from_json(F.col(value), schema, {"mode": "FAILFAST"})
    staged = df.select(_pinned(parsed).alias("_message"))
    message = F.col("_message")
    # One check for the whole message: pruning an unused field must not lift it.
    checked: Column = message
    for field in schema.fields:
        missing = F.raise_error(F.lit(f"missing field: {field.name}")).cast(schema)
        checked = F.when(message[field.name].isNull(), missing).otherwise(checked)
    return staged.select(checked.alias("_checked")).select(
        *[F.col(f"_checked.{name}").alias(name) for name in schema.fieldNames()]
    )


def register_json_table(
    df: DataFrame, name: str, schema: T.StructType, value: str = "value"
) -> DataFrame:
    """Register a strictly decoded message table under ``name`` for SQL."""
    table = strict_json(df, schema, value)
    table.createOrReplaceTempView(name)
    return table


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_valid")).drop("is_valid")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_valid"))
