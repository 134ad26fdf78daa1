"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import ensure_checkpoint_dir

U64 = np.uint64
_MUL = 0x9E3779B97F4A7C15
_MUL2 = 0xBF58476D1CE4E5B9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (vectorised); equal input gives equal output everywhere."""
    with np.errstate(over="ignore"):
        x = (x ^ U64((seed * _MUL) & 0xFFFFFFFFFFFFFFFF)) * U64(_MUL)
        x ^= x >> U64(29)
        x = x * U64(_MUL2)
        x ^= x >> U64(32)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as the signed longs Spark stores."""
    return np.ascontiguousarray(x).view(np.int64)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod ``modulus`` is ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(col).cast("string").cast("binary"), F.lit(b""))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of the row; maps, which cannot be hashed, by their JSON."""
    return F.xxhash64(*[F.to_json(F.col(f"`{c}`")) if "map<" in t else F.col(f"`{c}`") for c, t in df.dtypes])


#: Rows of an Arrow batch: whole texts pass through, so batches are kept to some megabytes.
ARROW_ROWS = 2500


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``ARROW_ROWS`` if it is larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows, of a few numbers each, up to which a counted table is broadcast; beyond, joins shuffle.
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The table marked for broadcast if its rows, which are counted here, are few enough.

    For tables already written or checkpointed, so that counting is cheap."""
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if max_rows is None else max_rows) else df


def stored(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Cut the lineage through a Parquet table in the shared folder (compressed, read by column; ``by`` in folders)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder that ``spark.checkpoint.dir`` names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
