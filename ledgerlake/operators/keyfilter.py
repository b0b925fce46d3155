"""A bitmap of key hashes, sent to every task, that thins out a large table before it is shuffled.

It may let through rows whose key is not wanted, never the other way round: an exact join follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap row (fixed by Spark's bitmap aggregate), bits a key, and the most rows: 32 MB.
ROW_BITS, KEY_BITS, MOST_ROWS = 2**15, 32, 2**13
_ROW, _MAP = "__key_row", "__key_map"


def _place(keys: Sequence[Column | str], rows: int) -> tuple[Column, Column]:
    """Bitmap row and bit of a key; a null in a key is a value like any other."""
    place = F.pmod(F.xxhash64(*keys), F.lit(rows * ROW_BITS))
    return F.shiftright(place, 15).cast("int"), place.bitwiseAND(F.lit(ROW_BITS - 1))


def key_bitmap(wanted: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """At most `rows` rows of 4 KB, of the hashes of the wanted keys; summed up map-side."""
    row, bit = _place([F.col(k) for k in keys], rows)
    return wanted.groupBy(row.alias(_ROW)).agg(F.bitmap_construct_agg(bit).alias(_MAP))


def rows_for(keys: int) -> int:
    """Bitmap rows for a number of keys, within the bound of what is sent to every task."""
    return min(max(-(-keys * KEY_BITS // ROW_BITS), 1), MOST_ROWS)


def likely_in(df: DataFrame, keys: Sequence[str], wanted: DataFrame, wanted_keys: Sequence[str], count: int) -> DataFrame:
    """Rows of `df` whose key may be among the wanted ones, without a shuffle of `df`.

    `count` is about the number of wanted keys and sets the size of the bitmap: about one unwanted row
    in 32 stays, up to 8 million keys, more of them beyond. Key types have to agree on both sides, as
    hashes are of typed values; where they don't, `df` is returned as it is.
    """
    types, other = dict(df.dtypes), dict(wanted.dtypes)
    if [types[k] for k in keys] != [other[k] for k in wanted_keys]:
        return df
    rows = rows_for(count)
    row, bit = _place([F.col(k) for k in keys], rows)
    byte = F.conv(F.hex(F.substr(F.col(_MAP), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    found = df.withColumn(_ROW, row).join(F.broadcast(key_bitmap(wanted, wanted_keys, rows)), _ROW)
    return found.where(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1).select(*df.columns)
