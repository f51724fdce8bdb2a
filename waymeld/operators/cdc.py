"""Keyed snapshots: latest row, wholesale replacement, diff and application, digests, dates and numbers that stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waymeld.operators.ranking import ranked


def latest_by_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")


def merge_replace(base: DataFrame, changed: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """All rows of a changed key replace that key's rows; deleted keys go, also changed ones. Null keys of base stay."""
    touched = changed.select(key).unionByName(deleted.select(key)).distinct()
    return base.join(touched, key, "left_anti").unionByName(changed.join(deleted, key, "left_anti"))


def merge_valid(base: DataFrame, changed: DataFrame, emptied: DataFrame, deleted: DataFrame, key: str, valid: Column) -> DataFrame:
    """merge_replace where keys of `emptied` changed to no rows at all, and every row left is checked for validity again."""
    gone = deleted.select(key).unionByName(emptied.select(key).join(changed.select(key), key, "left_anti"))
    return merge_replace(base, changed, gone, key).filter(F.coalesce(valid, F.lit(False)))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, op (added, removed, changed). Null equals null, also as a key; a column that only one side has counts as null on the other."""
    rest = sorted((set(old.columns) | set(new.columns)) - {key})
    side = lambda df, k: df.select(F.col(key).alias(f"_key_{k}"), F.struct(F.lit(1), *[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in rest]).alias(f"_row_{k}"))
    o, n = side(old, "old"), side(new, "new")
    same = F.lit(True)
    for c in rest:
        same = same & F.col(f"_row_old.{c}").eqNullSafe(F.col(f"_row_new.{c}"))
    op = F.when(F.col("_row_old").isNull(), "added").when(F.col("_row_new").isNull(), "removed").when(~same, "changed")
    both = o.join(n, F.col("_key_old").eqNullSafe(F.col("_key_new")), "full")
    return both.select(F.when(F.col("_row_old").isNull(), F.col("_key_new")).otherwise(F.col("_key_old")).alias(key), op.alias("op")).filter("op IS NOT NULL")


def apply_diff(old: DataFrame, new_rows: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """old with removed keys gone and new_rows in place of their keys."""
    return merge_replace(old, new_rows, removed, key)


def content_digest(df: DataFrame, skip: tuple = ()) -> DataFrame:
    """One row, `digest`: of the schema, the number of rows and all their values, whatever their order; columns in `skip` do not count."""
    cols = sorted(set(df.columns) - set(skip))
    row = lambda seed: F.xxhash64(F.lit(seed), *[F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in cols]).cast("decimal(38,0)")
    sums = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(row(1)), F.lit(0)).alias("a"), F.coalesce(F.sum(row(2)), F.lit(0)).alias("b"))
    kinds = ",".join(f"{c}:{dict(df.dtypes)[c]}" for c in cols)
    return sums.select(F.sha2(F.concat_ws("|", F.lit(kinds), "n", "a", "b"), 256).alias("digest"))


def keep_dates(rows: DataFrame, previous: DataFrame, key: str, date: str) -> DataFrame:
    """rows, where a row that equals its predecessor in all other columns takes that one's date; a column that only one side has is a change."""
    if set(rows.columns) != set(previous.columns):
        return rows
    was = previous.select(F.col(key).alias("_key"), F.struct(F.lit(1), *[F.col(c) for c in rows.columns if c != key]).alias("_was"))
    same = F.col("_was").isNotNull()
    for c in rows.columns:
        if c not in (key, date):
            same = same & F.col(c).eqNullSafe(F.col(f"_was.{c}"))
    joined = rows.join(was, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(date, F.when(same, F.col(f"_was.{date}")).otherwise(F.col(date))).select(*rows.columns)


def settled_ids(df: DataFrame, uid: str, length: str, place: str) -> DataFrame:
    """df where, of rows with one id, the longest keeps it and each other gets a suffix from the digest of its place."""
    first = F.row_number().over(W.partitionBy(uid).orderBy(F.col(length).desc_nulls_last(), place)) == 1
    return df.withColumn(uid, F.when(first, F.col(uid)).otherwise(F.concat(F.col(uid).cast("string"), F.lit("-"), F.substring(F.sha2(F.col(place).cast("string"), 256), 1, 8))))


def stable_numbers(keys: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Kept keys keep their number; new ones follow the largest ever given, in order of key. previous: key, number."""
    joined = keys.join(previous, key, "left")
    top = previous.agg(F.coalesce(F.max("number"), F.lit(0)).alias("_top"))
    fresh = ranked(joined.filter("number IS NULL").drop("number"), key, "_rank").join(F.broadcast(top))
    return joined.filter("number IS NOT NULL").select(key, "number").unionByName(fresh.select(key, (F.col("_top") + F.col("_rank")).alias("number")))
