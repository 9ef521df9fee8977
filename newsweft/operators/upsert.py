"""Keyed writes over Parquet tables: the final state as a DataFrame, and ways to put it in place."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of the same key; doing it twice changes nothing."""
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new)


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return existing.unionByName(new.join(existing.select(*keys), keys, "left_anti"))


def replace_slice(existing: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Delete the slices that ``new`` brings, then insert."""
    return existing.join(new.select(column).distinct(), column, "left_anti").select(*existing.columns).unionByName(new)


def merge_fields(existing: DataFrame, new: DataFrame, key: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """Fields of ``new`` that are not null overwrite those of ``existing``."""
    fields = [c for c in existing.columns if c != key and c in new.columns and c not in skip]
    joined = existing.alias("old").join(new.alias("new"), key, "left")
    return joined.select(*[F.col(key) if c == key else F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) if c in fields else F.col(f"old.{c}") for c in existing.columns])


def keep_comment(existing: DataFrame, new: DataFrame, key: str = "_id") -> DataFrame:
    """Whole-row upsert that keeps what people wrote into ``comment``."""
    old = existing.select(key, F.col("comment").alias("__c"))
    kept = new.join(old, key, "left").withColumn("comment", F.coalesce("__c", "comment", F.lit(""))).drop("__c")
    return upsert(existing, kept.select(*existing.columns), [key])


def swap(df: DataFrame, path: str) -> None:
    """Write beside the table and rename, so that a table may be rewritten from itself.

    Two renames: for an instant between them a reader finds no table. If the second fails, the old table comes back.
    """
    spark: SparkSession = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:8]}"
    df.write.mode("overwrite").parquet(staging)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")
    target, made = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(staging)
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"{path} could not be moved aside; the new table is in {staging}")
    if not fs.rename(made, target):
        if fs.exists(old):
            fs.rename(old, target)
        raise OSError(f"{staging} could not be moved to {path}")
    if fs.exists(old):
        fs.delete(old, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def upsert_partitions(new: DataFrame, path: str, keys: list[str], part: str) -> None:
    """Upsert into a Parquet table partitioned by ``part``: only the partitions that ``new`` touches are read and replaced."""
    spark: SparkSession = new.sparkSession
    if exists(spark, path):
        old = spark.read.schema(new.schema).parquet(path)
        new = upsert(old.join(new.select(part).distinct(), part, "left_semi").select(*new.columns), new, keys)
    new.write.partitionBy(part).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
