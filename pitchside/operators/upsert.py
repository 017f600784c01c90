"""Stored state without MERGE: keep-last, upsert, delete and fill, as joins that shuffle on the keys alone."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import KEYS


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key; `order` says which is last, and should decide between all rows."""
    last = [c.desc_nulls_last() if isinstance(c, Column) else F.col(c).desc_nulls_last() for c in order]
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*last))).where("_rank = 1").drop("_rank")


def delete(target: DataFrame, gone: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """`target` without the keys of `gone`. Keys are compared column by column."""
    return target.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows replace those of equal keys, or are added. `rows` has one row per key."""
    return target.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows.select(*target.columns))


def apply_changes(target: DataFrame, changes: DataFrame, order: Sequence[Column | str], deleted: Column, keys: Sequence[str] = KEYS, strict: bool = False) -> DataFrame:
    """A batch of changes. By default deletions go first, so a key that is both deleted and updated stays; `strict`
    takes the last change of each key, whichever it is."""
    changes = changes.withColumn("_gone", F.coalesce(deleted, F.lit(False)))
    if strict:
        changes = keep_last(changes, keys, order)
        return upsert(delete(target, changes.where("_gone"), keys), changes.where("not _gone"), keys)
    kept = keep_last(changes.where("not _gone"), keys, order)
    return upsert(delete(target, changes.where("_gone"), keys), kept, keys)


def fill(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Iterable[str], empty: Callable[[Column], Column] = Column.isNull, gate: Column | None = None) -> DataFrame:
    """Columns that are empty take the source's values; `gate` names the rows that may change (all by default). The
    source has one row per key."""
    columns = list(columns)
    given = source.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in columns))
    both = target.join(given, list(keys), "left")
    may = F.lit(True) if gate is None else F.coalesce(gate, F.lit(False))
    values = {c: F.when(may & empty(F.col(c)), F.coalesce(f"_new_{c}", c)).otherwise(F.col(c)) for c in columns}
    return both.select(*(values[c].alias(c) if c in values else F.col(c) for c in target.columns))


def update_from(target: DataFrame, lookup: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns take the lookup's values where the key is found there."""
    given = lookup.select(*on, *(F.col(c).alias(f"_new_{c}") for c in columns))
    both = target.join(given, list(on), "left")
    return both.select(*(F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns))


def replace_dedup(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Old and new rows together, of each key the new one, and among the new ones the last."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return keep_last(both, keys, ["_new", *order]).drop("_new")


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_run(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("run_date").parquet(path)


def replace_run(df: DataFrame, path: str) -> None:
    """The run's rows replace those of the same run_date only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)
