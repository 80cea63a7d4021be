"""A Bloom filter of keys that thins a table before anything of it is shuffled.

The filter is a set of bitmaps of 32,768 bits. Its size follows the counted keys up
to ``MOST_PAGES`` bitmaps (32 MB), so broadcasting it is bounded whatever the data;
beyond that more rows pass by chance, and an exact join after it decides either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_BITS = 32_768
MOST_PAGES = 8_192
BITS_PER_KEY = 16


def sieve(keys: DataFrame, names: list[str], count: int | None = None) -> DataFrame:
    """(_page, _bits): the bitmaps of the distinct ``names`` of ``keys``."""
    count = keys.count() if count is None else count
    pages = min(MOST_PAGES, max(1, -(-count * BITS_PER_KEY // PAGE_BITS)))
    place = F.pmod(F.xxhash64(*names), F.lit(pages * PAGE_BITS))
    placed = keys.select(place.alias("_place"))
    return placed.groupBy(F.expr(f"_place div {PAGE_BITS}").alias("_page")).agg(
        F.bitmap_construct_agg(F.col("_place") % PAGE_BITS).alias("_bits"),
        F.lit(pages).alias("_pages"),
    )


def sifted(rows: DataFrame, names: list[str], bitmaps: DataFrame, pages: int) -> DataFrame:
    """The rows whose ``names`` may be among the keys; none that is, is lost.

    ``bitmaps`` is a ``sieve`` of equally typed columns that has been written.
    """
    return with_chance(rows, names, bitmaps, pages).where("_may").select(*rows.columns)


def with_chance(rows: DataFrame, names: list[str], bitmaps: DataFrame, pages: int) -> DataFrame:
    """All rows, with ``_may``: whether their ``names`` may be among the keys."""
    place = F.pmod(F.xxhash64(*names), F.lit(pages * PAGE_BITS))
    placed = rows.withColumn("_place", place)
    own = F.broadcast(bitmaps.select("_page", "_bits"))
    met = placed.join(own, F.expr(f"_place div {PAGE_BITS}") == F.col("_page"), "left")
    octet = F.expr(f"conv(hex(substring(_bits, CAST(_place % {PAGE_BITS} div 8 AS INT) + 1, 1)), 16, 10)")
    bit = F.call_function("shiftright", octet.cast("int"), (F.col("_place") % 8).cast("int"))
    may = F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return met.select(*rows.columns, may.alias("_may"))


def matching(
    rows: DataFrame, keys: DataFrame, names: list[str], broadcast_rows: int
) -> DataFrame:
    """``rows`` that match a row of ``keys`` in the columns ``names``, none of them NULL.

    ``keys`` is a written table. Few keys are broadcast; of more, a sieve keeps the
    rows that cannot match from being shuffled.
    """
    count = keys.count()
    if count <= broadcast_rows:
        return rows.join(F.broadcast(keys), names, "left_semi")
    from tidemark.session import pin

    bitmaps = pin(sieve(keys, names, count))
    pages = bitmaps.first()["_pages"]
    return sifted(rows, names, bitmaps, pages).join(keys, names, "left_semi")
