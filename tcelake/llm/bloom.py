"""A bitmap of fixed size over 64-bit hashes, used only to leave out rows that a later exact join would drop anyway.

The bitmap has ``BITS`` bits whatever the input, so what is collected and broadcast never passes 8 MB. A full one lets
everything through: results are the same, only the join behind it reads more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
_LOW, _SHIFT, _SIX = np.uint64(BITS - 1), np.uint64(26), np.uint64(6)


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return h & _LOW, (h >> _SHIFT) & _LOW


def may_hold(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) may have been put in; never False for one that was."""
    out = np.ones(len(h), dtype=bool)
    for place in _places(h):
        out &= (bitmap[(place >> _SIX).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


def bitmap_of(rows: DataFrame, hashes: Callable) -> np.ndarray:
    """The bitmap of all rows; ``hashes`` gives the uint64 hashes of an Arrow batch. Tasks or their bits together locally,
    the rest is or-ed by word, so at most ``BITS`` / 64 words reach the driver."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        bits = np.zeros(BITS // 64, dtype=np.uint64)
        for batch in batches:
            for place in _places(hashes(batch)):
                np.bitwise_or.at(bits, (place >> _SIX).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(bits[used].view(np.int64))], names=["word", "bits"])

    words = rows.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out
