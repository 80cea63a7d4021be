"""Records fetched by their place in the source.

A row of a Parquet table has a place: its file and its number in it. Where only one
row of a key is wanted whole, the place travels through the narrow plan in two longs,
and the wide columns are read in a second scan for the winners alone. Unlike a join on
(key, order) a place is unique, whatever repeats in the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.chunks import BROADCAST_ROWS
from tidemark.operators.sieve import matching
from tidemark.session import pin

#: Hash of the file's path, and the row's number in the file.
PLACE = ["_file", "_row"]


def with_place(scan: DataFrame) -> DataFrame:
    """Adds ``PLACE`` to a DataFrame that reads Parquet files."""
    return scan.withColumns(
        {
            PLACE[0]: F.xxhash64("_metadata.file_path"),
            PLACE[1]: F.col("_metadata.row_index"),
        }
    )


def fetch(
    rows: DataFrame, wanted: DataFrame, key: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The rows at the places of ``wanted``, whole, without ``PLACE``.

    ``wanted`` has the key too, so that two paths of one hash cannot be mixed up.
    Rows are filtered by place before any exchange: few places are broadcast, more
    are first sifted.
    """
    names = [*PLACE, key]
    places = pin(wanted.select(*names).where(F.col(key).isNotNull()))
    found = matching(rows, places, names, broadcast_rows)
    if wanted.schema[key].nullable:
        # NULL is a key like any other, and there is one of it at most.
        nameless = F.broadcast(pin(wanted.where(F.col(key).isNull()).select(*PLACE).limit(1)))
        unnamed = rows.where(F.col(key).isNull()).join(nameless, PLACE, "left_semi")
        found = found.unionByName(unnamed)
    return found.drop(*PLACE)
