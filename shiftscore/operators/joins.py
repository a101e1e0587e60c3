"""Restricting a big table to the keys in hand.

Keys are broadcast only if a plain count of rows that hold them (one number
per partition, nothing is moved) proves them few.  Otherwise the semi join
carries no hint: it is shuffled, and AQE may still broadcast or split by the
sizes it measures.  Before that shuffle the big table is cut, in its own scan
stage, by a filter of hashed keys whose size is fixed: one bit for each of
``slots`` hash values, in words of 64, so at most ``slots / 64`` rows are
broadcast, however many keys there are.  Rows of keys that are not in hand pass
only where their bit is another key's, a share of about ``keys / slots``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def proven_small(rows: DataFrame, limit: int) -> bool:
    """Whether ``rows``, and so any distinct keys in them, are at most ``limit``."""
    return rows.count() <= limit


class KeySet:
    """Non-NULL keys.

    ``small`` says that the rows with keys are proven few: they are then
    broadcast as they are, otherwise made distinct and kept in the cache.
    """

    def __init__(self, rows: DataFrame, key: Column | str, small: bool = False, slots: int = 0):
        c = F.col(key) if isinstance(key, str) else key
        self.small, self.slots, self._filter = small, slots, None
        keys = rows.select(c.alias("key")).where("key IS NOT NULL")
        # A small set is cut from rows that are cached themselves, and one query broadcasts it once.
        self.frame = keys if small else keys.distinct().persist(StorageLevel.MEMORY_AND_DISK)

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.slots))

    def filter(self) -> DataFrame:
        """The hashed keys: ``_word``, ``_bits``."""
        if self._filter is None:
            slot = self._slot(F.col("key"))
            bit = F.expr("shiftleft(1L, cast(_slot % 64 AS int))")
            self._filter = (self.frame.select(slot.alias("_slot")).select(F.expr("_slot div 64").alias("_word"), bit.alias("_bit"))
                            .groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))).persist(StorageLevel.MEMORY_AND_DISK)
        return self._filter

    def prefilter(self, df: DataFrame, on: Column | str) -> DataFrame:
        """Rows of ``df`` whose ``on`` may be one of the keys; nothing is shuffled."""
        if self.small or not self.slots:
            return df
        c = (df[on] if isinstance(on, str) else on).cast(self.frame.schema["key"].dataType)
        marked = df.withColumn("_slot", self._slot(c)).withColumn("_at", F.expr("_slot div 64"))
        hit = marked.join(F.broadcast(self.filter()), F.col("_at") == F.col("_word"))
        return hit.where(F.expr("(shiftright(_bits, cast(_slot % 64 AS int)) & 1L) = 1")).select(*df.columns)

    def side(self) -> DataFrame:
        return F.broadcast(self.frame) if self.small else self.frame

    def restrict(self, df: DataFrame, on: Column | str) -> DataFrame:
        """Rows of ``df`` whose ``on`` is one of the keys; no key gives no row."""
        df = self.prefilter(df, on)
        k = self.side()
        c = df[on] if isinstance(on, str) else on
        return df.join(k, c == k["key"], "left_semi")

    def release(self) -> None:
        if not self.small:
            self.frame.unpersist()
        if self._filter is not None:
            self._filter.unpersist()
