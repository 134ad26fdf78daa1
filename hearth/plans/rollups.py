"""E-01 incremental roll-ups: premium sums per month and broker kept up to date by signed deltas.

The premium fact lies in key-hash buckets.  A load takes the feed's rows
after the high-water mark of load times, looks up the rows they replace (in
the touched buckets only), and turns each correction into a delta: the old row
counts -1 and its amount is taken off where it was booked, the new one +1 where
it belongs now.  The deltas, summed per group, are added to the stored sums, so
neither the fact nor the sums are computed again.

Each load writes its sums and its mark under its own number, before the fact's
buckets: a load that failed can be run again under the same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearth.operators.buckets import BUCKET, bucketed, read_buckets, replace_rows, touched
from hearth.operators.dedupe import latest
from hearth.sources.files import staged, write_table

KEYS = ["PremiumTransactionID"]
LOAD_COL = "LoadDts"


class PremiumRollups:
    """The stored premium fact of one folder with its monthly and broker sums."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, buckets: int = 64):
        self.spark, self.path, self.schema, self.buckets = spark, path, schema, buckets

    def sums(self, load: int) -> DataFrame:
        """``grain, key, rows, net_premium`` after a load."""
        return self.spark.read.parquet(f"{self.path}/sums/load-{load}")

    def mark(self, load: int):
        """The greatest load time seen so far."""
        return self.spark.read.parquet(f"{self.path}/mark/load-{load}").first()["mark"]

    def fact(self) -> DataFrame:
        return read_buckets(self.spark, f"{self.path}/fact", self.schema).drop(BUCKET)

    def _sums_of(self, signed: DataFrame, policies: DataFrame) -> DataFrame:
        """Signed rows as one row per month and one per broker that they touch."""
        amount = F.sum(F.coalesce(F.col("NetPremium"), F.lit(0)) * F.col("_sign")).cast("decimal(28,2)").alias("net_premium")
        month = (signed.groupBy(F.coalesce(F.date_format("TransactionDate", "yyyy-MM"), F.lit("Unknown")).alias("key"))
                       .agg(F.sum("_sign").alias("rows"), amount))
        # per policy first: a policy with a third of the rows is one row of the join
        policy = signed.groupBy("PolicyID").agg(F.sum("_sign").alias("rows"), amount)
        broker = (policy.join(policies.select("PolicyID", "BrokerID"), "PolicyID", "left")
                        .groupBy(F.coalesce("BrokerID", F.lit("Unknown")).alias("key"))
                        .agg(F.sum("rows").alias("rows"), F.sum("net_premium").cast("decimal(28,2)").alias("net_premium")))
        return (month.select(F.lit("month").alias("grain"), "key", "rows", "net_premium")
                     .unionByName(broker.select(F.lit("broker").alias("grain"), "key", "rows", "net_premium")))

    def changes(self, load: int, feed: DataFrame) -> DataFrame:
        """The feed's newest row per key after the mark, with its bucket, written."""
        if load > 1:
            feed = feed.filter(F.col(LOAD_COL).isNull() | (F.col(LOAD_COL) > F.lit(self.mark(load - 1))))
        return staged(bucketed(latest(feed, KEYS, [LOAD_COL]), KEYS, self.buckets), "rollup-feed")

    def replaced(self, new: DataFrame) -> DataFrame:
        """The stored rows that ``new`` replaces; reads the buckets of ``new`` only."""
        old = read_buckets(self.spark, f"{self.path}/fact", self.schema, touched(new))
        return old.join(new.select(*KEYS), KEYS, "left_semi").select(old.columns)

    def load(self, load: int, feed: DataFrame, policies: DataFrame) -> list[int]:
        """Bring fact and sums up to date from ``feed`` (loads count from 1); returns the buckets written."""
        new = self.changes(load, feed)
        signed = new.withColumn("_sign", F.lit(1))
        if load > 1:
            signed = signed.unionByName(self.replaced(new).withColumn("_sign", F.lit(-1)))
        sums = self._sums_of(signed, policies)
        if load > 1:
            sums = (self.sums(load - 1).unionByName(sums).groupBy("grain", "key")
                        .agg(F.sum("rows").alias("rows"), F.sum("net_premium").cast("decimal(28,2)").alias("net_premium"))
                        .filter("rows <> 0"))
        write_table(sums, f"{self.path}/sums/load-{load}")
        marks = new.select(F.col(LOAD_COL).alias("mark"))
        if load > 1:
            marks = marks.unionByName(self.spark.read.parquet(f"{self.path}/mark/load-{load - 1}"))
        write_table(marks.agg(F.max("mark").alias("mark")), f"{self.path}/mark/load-{load}")
        if load == 1:
            write_table(new.repartition(F.col(BUCKET)), f"{self.path}/fact", partition_by=(BUCKET,))
            return touched(new)
        return replace_rows(f"{self.path}/fact", self.schema, new, KEYS)
