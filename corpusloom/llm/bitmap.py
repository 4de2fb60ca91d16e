"""A bitmap of fixed size that lets a scan drop most rows a later join would drop.

Its size never depends on the data, so it may go to every task. A full bitmap
passes every row: the join that follows is what decides, at any size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.session import stage_table

#: 64-bit words: 1 MB.
WORDS = 1 << 17


class maybe_in:
    """Splits frames with ``keys`` by whether ``wanted(keys)`` may hold a row's key; a null key is never held."""

    def __init__(self, wanted: DataFrame, keys: list[str], words: int = WORDS):
        self.keys, self.size = keys, words * 64
        found = wanted.select(self._at(), *keys).groupBy(F.floor(F.col("at") / 64).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("w"))
        part = found.toArrow()  # at most ``words`` rows of two numbers
        packed = np.zeros(words, "<i8")
        packed[part.column("i").to_numpy()] = part.column("w").to_numpy()
        # by way of a table and a scalar subquery: as a literal it would stand in every plan and its text
        one = stage_table(wanted.sparkSession.createDataFrame([(bytearray(packed.tobytes()),)], "m binary"), "bitmap")
        self.bits = one.select("m").scalar()

    def _at(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.size)).alias("at")

    def _held(self) -> Column:
        at = self._at()
        byte = F.conv(F.hex(F.substring(self.bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8 + 1).cast("int"))
        nulls = F.lit(True)
        for k in self.keys:
            nulls = nulls & F.col(k).isNotNull()
        return nulls & (byte.bitwiseAND(bit) != 0)

    def keep(self, df: DataFrame) -> DataFrame:
        return df.filter(self._held())

    def drop(self, df: DataFrame) -> DataFrame:
        return df.filter(~self._held())

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.keep(df)
