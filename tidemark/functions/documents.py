"""JSON documents at the edges; inside, rows stay typed structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import CLOCK_FORMAT

# NULL members stay in the document, and clocks have no ISO "T".
WRITE_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": CLOCK_FORMAT}
READ_OPTIONS = {"timestampNTZFormat": CLOCK_FORMAT, "mode": "PERMISSIVE"}


def to_document(value: Column) -> Column:
    return F.to_json(value, WRITE_OPTIONS)


def from_document(text: Column, schema: T.StructType) -> Column:
    return F.from_json(text, schema, READ_OPTIONS)


def merge_structs(*parts: tuple[Column, list[str]]) -> Column:
    """One struct with the members of several; a later part wins on a clash."""
    members: dict[str, Column] = {}
    for struct, names in parts:
        for name in names:
            members[name] = struct.getField(name).alias(name)
    return F.struct(*members.values())
