"""The warehouse as one lazily built object over a data folder.

``Warehouse(spark, sf_dir)`` exposes every layer as DataFrames.  Nothing is
computed until an action runs; each property builds its logical plan once
and is memoised on the instance, so a report that needs silver policy twice
reuses one plan (Catalyst/AQE reuse the exchange when both branches are the
same sub-plan).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DecimalType, IntegerType, ShortType

from hearth.operators.quality import Classified
from hearth.plans import bronze as B
from hearth.plans import silver as S
from hearth.sources import testviews as tv

# Fixed run parameters of the derived test data (reproducible reruns, H-10).
DEFAULT_NOW = datetime(2002, 1, 1, 0, 0, 0)
DEFAULT_AS_OF = S.DEFAULT_AS_OF

TECHNICAL = ("BronzeLoadDts", "SilverLoadDts", "GoldLoadDts", "RejectLoadDts", "SourceFile")


def present(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Query output convention: no load metadata, money and ratios as
    double (exact decimal sums converted once at the end), integers as
    bigint, booleans as 0/1."""
    cols = []
    for f in df.schema.fields:
        if f.name in TECHNICAL and f.name not in keep:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType, BooleanType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Warehouse:
    """Every layer as DataFrames over ``sf_dir``.

    With ``store`` (a folder written by ``hearth.plans.store.build_store``)
    the layers listed in ``stored`` are read from their written tables
    instead of being derived again: the normal shape of a warehouse, where
    the load runs once and reports read gold."""

    def __init__(self, spark: SparkSession, sf_dir: str, now: datetime = DEFAULT_NOW,
                 as_of: date = DEFAULT_AS_OF, store: str | None = None,
                 stored: tuple[str, ...] = ("bronze", "silver", "gold"), previous_store: str | None = None,
                 asked: Sequence[str] | None = None):
        self.asked = asked              # what is read of every silver table, if not all
        self.spark, self.sf_dir, self.now, self.as_of = spark, sf_dir, now, as_of
        self.store, self.stored, self.previous_store = store, (stored if store else ()), previous_store
        self._silver: dict[str, tuple[DataFrame, DataFrame]] = {}
        self._lines: DataFrame | None = None

    def counting(self) -> Warehouse:
        """The same tables for counting their rows: derivations determine keys and verdicts alone,
        so a whole row is neither compared, sorted nor shuffled where neither needs it."""
        return Warehouse(self.spark, self.sf_dir, self.now, self.as_of, self.store, self.stored, self.previous_store, asked=())

    def previous(self, dimension: str) -> DataFrame | None:
        """The image of a dimension that the load before this one wrote, if there was one."""
        return self.spark.read.parquet(f"{self.previous_store}/gold/{dimension}") if self.previous_store else None

    # -- sources -----------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        return tv.table(self.spark, self.sf_dir, name)

    def raw(self, entity: str) -> DataFrame:
        return tv.raw(self.spark, self.sf_dir, entity)

    def bronze(self, entity: str) -> DataFrame:
        if "bronze" in self.stored:
            return self.spark.read.parquet(f"{self.store}/bronze/{entity}")
        return B.bronze(self.raw(entity), entity, self.now)

    # -- silver ------------------------------------------------------------
    def classified(self, entity: str, grain: str = "declared", asked: Sequence[str] | None = None) -> Classified:
        """All rows of an entity with their verdict, derived from its bronze (``asked``: see ``S.ASKED``)."""
        fn, b = S.SILVER[entity], self.bronze(entity)
        asked = self.asked if asked is None else asked
        if asked is not None and grain == "declared" and entity in S.ASKED:
            return fn(b, self.now, asked=asked)
        if entity == "claim_reserves":
            return fn(b, self.now, self.as_of)
        if grain == "reference" and entity in ("coverage", "policy_risk"):
            return fn(b, self.now, ["PolicyID"])
        return fn(b, self.now)

    def silver_pair(self, entity: str, grain: str = "declared") -> tuple[DataFrame, DataFrame]:
        key = f"{entity}:{grain}"
        if key not in self._silver:
            c = self.classified(entity, grain)
            if "silver" in self.stored:
                name = entity if grain == "declared" else f"{entity}__{grain}"
                # the schema is given, so an entity without a single row can be read as well
                c = Classified(self.spark.read.schema(c.rows.schema).parquet(f"{self.store}/silver/{name}"))
            self._silver[key] = (c.good, c.reject)
        return self._silver[key]

    def counted(self) -> DataFrame | None:
        """``layer, entity, rows`` as counted while the store was written, if there is one."""
        return self.spark.read.parquet(f"{self.store}/counts") if "gold" in self.stored else None

    def policy_lines(self) -> DataFrame | None:
        """The rows of the policy grain in buckets of PolicyID, if a store holds them."""
        if "gold" not in self.stored:
            return None
        if self._lines is None:
            from hearth.operators.buckets import colocated_table
            from hearth.plans.store import POLICY_LINES
            self._lines = colocated_table(self.spark, f"{self.store}/{POLICY_LINES}")
        return self._lines

    def silver(self, entity: str, grain: str = "declared", columns: Sequence[str] | None = None) -> DataFrame:
        """The good rows; with ``columns`` only those, and a derivation compares and moves no more than they need."""
        if columns is None:
            return self.silver_pair(entity, grain)[0]
        if "silver" in self.stored:
            return self.silver_pair(entity, grain)[0].select(*columns)
        return self.classified(entity, grain, columns).good.select(*columns)

    def rejects(self, entity: str, grain: str = "declared") -> DataFrame:
        return self.silver_pair(entity, grain)[1]

    # -- gold (built in hearth.plans.gold) -----------------------------------
    @cached_property
    def gold(self):
        from hearth.plans.gold import Gold
        return Gold(self)
