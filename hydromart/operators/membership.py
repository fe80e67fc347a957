"""Membership of row identities in a mart without shuffling the mart (SNK-09, JN-11).

The identities of a mart are indexed twice: as a bucketed table with one row per identity, and as
bitmaps with one bit for each hash value (``BITS_PER_ROW`` times as many bits as rows, rounded up
to a power of two, 4 KB a bitmap). A row whose bit is unset is certainly new. Only the others are
looked up, and that join reads the index in its buckets: the incoming rows move, the mart's do not.

A NULL identity names no row: it is never known, as in a join on equality.

Bitmaps merge with a bitwise or, so rows added to a mart are added to its index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.operators import tables
from hydromart.operators.bucketed import BucketedTable
from hydromart.session import checkpoint_dir

BITS_PER_ROW = 16
BITMAP_BITS = 32768  # Spark's own bitmaps
_HASH = "identity"


def _slot(identity: Column, bits: int) -> Column:
    """Bit number of an identity, from 1 as the bitmap functions count."""
    return F.pmod(F.xxhash64(identity), F.lit(bits)) + 1


def bitmap_bits(rows: int) -> int:
    wanted = max(rows * BITS_PER_ROW, BITMAP_BITS)
    return 1 << (wanted - 1).bit_length()


def bitmaps_of(identities: DataFrame, bits: int) -> DataFrame:
    """(part, bits): the bitmaps of ``identities(identity)``; one partial bitmap a task and part."""
    slot = _slot(F.col(_HASH), bits)
    return (identities.select(F.bitmap_bucket_number(slot).alias("part"), F.bitmap_bit_position(slot).alias("at"))
            .groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits")))


def bit_is_set(bits: Column, at: Column) -> Column:
    """Whether bit ``at`` of a bitmap is set; a missing bitmap holds none."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))


class IdentityIndex:
    """The identities of a mart: an exact bucketed table and its bitmaps."""

    def __init__(self, spark: SparkSession, root: str, exact: BucketedTable, bits: int):
        self.spark, self.root, self.exact, self.bits = spark, root.rstrip("/"), exact, bits

    @property
    def _bitmap_path(self) -> str:
        return f"{self.root}/bitmaps"

    @classmethod
    def build(cls, mart: DataFrame, root: str, hash_col: str = "row_hash", buckets: int | None = None) -> IdentityIndex:
        root = root.rstrip("/")
        identities = mart.select(F.col(hash_col).alias(_HASH)).where(F.col(_HASH).isNotNull()).distinct()
        exact = BucketedTable.create(identities, f"{root}/exact", [_HASH], buckets)
        index = cls(mart.sparkSession, root, exact, bitmap_bits(exact.read().count()))
        tables.write_table(bitmaps_of(exact.read(), index.bits).withColumn("of", F.lit(index.bits)), index._bitmap_path)
        return index

    @classmethod
    def attach(cls, spark: SparkSession, root: str) -> IdentityIndex:
        index = cls(spark, root, BucketedTable.attach(spark, f"{root.rstrip('/')}/exact"), BITMAP_BITS)
        size = index.bitmaps().agg(F.max("of")).first()[0]
        index.bits = size if size is not None else index.bits
        return index

    def bitmaps(self) -> DataFrame:
        return self.spark.read.schema("part long, bits binary, of long").parquet(self._bitmap_path)

    def add(self, rows: DataFrame, hash_col: str = "row_hash") -> int:
        """Index rows that were added to the mart; the number of new identities.

        The bits grow with the table: when they would fall under half of ``BITS_PER_ROW`` a row, the
        bitmaps are rebuilt from the exact table.
        """
        checkpoint_dir(self.spark)
        new = rows.select(F.col(hash_col).alias(_HASH)).where(F.col(_HASH).isNotNull()).distinct()
        new = new.join(self.exact.read(), _HASH, "left_anti").checkpoint(eager=True)
        n = new.count()
        if not n:
            return 0
        self.exact.append(new)
        total = self.exact.read().count()
        if 2 * self.bits < total * BITS_PER_ROW:
            self.bits = bitmap_bits(total)
            merged = bitmaps_of(self.exact.read(), self.bits)
        else:
            merged = (self.bitmaps().select("part", "bits").unionByName(bitmaps_of(new, self.bits))
                      .groupBy("part").agg(F.bitmap_or_agg("bits").alias("bits")))
        tables.write_table(merged.withColumn("of", F.lit(self.bits).cast("long")), self._bitmap_path)
        return n

    def maybe_known(self, rows: DataFrame, hash_col: str = "row_hash") -> DataFrame:
        """``rows`` with ``_maybe``: false where the identity is certainly not in the index."""
        slot = _slot(F.col(hash_col), self.bits)
        asked = rows.withColumns({"_part": F.bitmap_bucket_number(slot), "_at": F.bitmap_bit_position(slot)})
        held = self.bitmaps().select(F.col("part").alias("_part"), F.col("bits").alias("_bits"))
        return (asked.join(held, "_part", "left")
                .withColumn("_maybe", bit_is_set(F.col("_bits"), F.col("_at")))
                .drop("_part", "_at", "_bits"))

    def absent(self, rows: DataFrame, hash_col: str = "row_hash") -> DataFrame:
        """The rows whose identity is not in the index, exactly."""
        asked = self.maybe_known(rows, hash_col)
        return asked.where(~F.col("_maybe")).unionByName(self.look_up(asked.where("_maybe"), hash_col)).drop("_maybe")

    def look_up(self, rows: DataFrame, hash_col: str = "row_hash") -> DataFrame:
        """The rows that the exact table lacks; only ``rows`` are shuffled, to its buckets."""
        known = self.exact.read()
        return rows.join(known, F.col(hash_col) == known[_HASH], "left_anti")


def incremental_rows(source: DataFrame, mart: DataFrame, index: IdentityIndex, date: str = "date",
                     hash_col: str = "row_hash", lookback_days: int = 35) -> DataFrame:
    """SNK-09 like ``tables.incremental_rows``: recent rows, or rows whose identity the mart lacks.

    Recent rows need no lookup, nor do rows whose bit is unset; only the others meet the exact table.
    The two branches read the source once each (one of them again through a reused exchange).
    """
    edge = mart.agg(F.date_sub(F.max(date), lookback_days)).scalar()
    asked = index.maybe_known(source.withColumn("_recent", F.coalesce(F.col(date) >= edge, F.lit(False))), hash_col)
    settled = F.col("_recent") | ~F.col("_maybe")
    return asked.where(settled).unionByName(index.look_up(asked.where(~settled), hash_col)).drop("_recent", "_maybe")
