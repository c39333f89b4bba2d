"""A fixed-size bitmap over ids, to spare a later scan the rows that no candidate names.

2 MB at any input size. A bit may also stand for other ids; whoever reads
with it joins exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

BITS = 1 << 24


def id_bitmap(ids: DataFrame, column: str) -> bytes:
    """Bitmap of a binary column, by its first three bytes."""
    place = F.conv(F.hex(F.substring(column, 1, 3)), 16, 10).cast("long") + 1
    parts = ids.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()  # at most 512 rows of 4 KB
    whole = np.zeros(BITS // 8, dtype=np.uint8)
    for row in parts:
        at = (row["bucket"] - 1) * 4096
        whole[at:at + 4096] |= np.frombuffer(row["bits"], dtype=np.uint8)
    return whole.tobytes()


def in_bitmap(bitmap: bytes, some_id: bytes) -> bool:
    place = int.from_bytes(some_id[:3], "big")
    return bool(bitmap[place >> 3] >> (place & 7) & 1)
