"""Joins on keys of which a few hold most rows (X-19, J-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .sampling import broadcast_if_small

ROWS_A_TASK = 1 << 20


def heavy_keys(rows: DataFrame, key: str, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """(key, splits) of the keys with more than ``rows_a_task`` rows: at most one for so
    many rows of the table.  Counts are combined before they are shuffled."""
    return (rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_a_task)
            .select(key, F.ceil(F.col("n") / rows_a_task).cast("int").alias("splits")))


def split_join(rows: DataFrame, facts: DataFrame, key: str, spread: str, rows_a_task: int = ROWS_A_TASK,
               heavy: DataFrame | None = None) -> DataFrame:
    """``rows`` left-joined with ``facts`` (one row a key) on ``key``.  A heavy key is
    dealt over tasks by the hash of ``spread``, and its one row of facts is sent to each
    of them; all other keys are joined as usual.  ``heavy`` (key, splits) may be given
    where counts are known already.  Null keys match nothing."""
    ensure_checkpoint_dir(rows.sparkSession)
    heavy = (heavy_keys(rows, key, rows_a_task) if heavy is None else heavy).select(F.col(key).alias("__k"), "splits").checkpoint()
    size = heavy.agg(F.sum(F.octet_length(F.col("__k").cast("string")) + 32)).first()[0] or 0
    heavy = broadcast_if_small(heavy, size)
    split = F.coalesce("splits", F.lit(1))
    salted = rows.join(heavy, rows[key] == heavy["__k"], "left").withColumn("__s", F.pmod(F.xxhash64(spread), split).cast("int")).drop("__k", "splits")
    sent = facts.join(heavy, facts[key] == heavy["__k"], "left").withColumn("__s", F.explode(F.sequence(F.lit(0), split - 1))).drop("__k", "splits")
    return salted.join(sent, [key, "__s"], "left").drop("__s")
