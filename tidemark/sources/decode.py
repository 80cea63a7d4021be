"""JSON text to typed observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.documents import READ_OPTIONS
from tidemark.schema import OBSERVATION_SCHEMA

CORRUPT = "_malformed"


def wire_schema(schema: T.StructType = OBSERVATION_SCHEMA) -> T.StructType:
    """The schema as parsed: flags stay text, since a parser that expects a
    BOOLEAN turns 0 and 1 into NULL."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType,
            )
            for f in schema.fields
        ]
    )


def flag(text: Column, how: str = "lenient") -> Column:
    """A flag from its text. ``lenient`` reads 0/1 and true/false; ``legacy``
    takes only the word true for true and everything else for false."""
    word = F.lower(F.trim(text))
    if how == "legacy":
        return F.when(text.isNotNull(), word == "true")
    if how != "lenient":
        raise ValueError("flags are read 'lenient' or 'legacy'")
    return F.when(word.isin("true", "1"), True).when(word.isin("false", "0"), False)


def decode_json(
    df: DataFrame,
    value: str = "value",
    schema: T.StructType = OBSERVATION_SCHEMA,
    flags: str = "lenient",
    keep: list[str] | None = None,
) -> DataFrame:
    """One typed row per message.

    Text that does not parse keeps its row: its fields are NULL and the text is
    in ``_malformed`` for ``sources.quality`` to set aside. ``keep`` names
    columns of ``df`` (arrival order and such) to pass along.
    """
    text = F.col(value).cast("string")
    parsed_as = wire_schema(schema).add(CORRUPT, T.StringType())
    options = READ_OPTIONS | {"columnNameOfCorruptRecord": CORRUPT}
    kept = keep or []
    parsed = df.select(
        *kept,
        text.alias("_text"),
    )
    # Exploded, so that a text is parsed once: the optimizer would put the parse into
    # every test that a filter makes on a field.
    row = F.from_json(F.col("_text"), parsed_as, options)
    parsed = parsed.select(*kept, "_text", F.explode(F.array(row)).alias("_row"))
    columns = []
    for field in schema.fields:
        member = F.col("_row").getField(field.name)
        if isinstance(field.dataType, T.BooleanType):
            member = flag(member, flags)
        columns.append(member.alias(field.name))
    unread = F.col("_row").isNull() & F.col("_text").isNotNull()
    broken = F.when(unread, F.col("_text")).otherwise(F.col("_row").getField(CORRUPT))
    return parsed.select(*kept, *columns, broken.alias(CORRUPT))
