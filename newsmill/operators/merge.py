"""Upserts.  Pure forms return the merged frame; table forms rewrite only the touched partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsmill.operators.keys import first_per_nonnull_key
from newsmill.session import materialize, scratch_path


def merge_update(target: DataFrame, incoming: DataFrame, keys: list, order) -> DataFrame:
    """INSERT .. ON CONFLICT DO UPDATE; of several incoming rows with one key the first by ``order`` wins."""
    fresh = first_per_nonnull_key(incoming, keys, order)
    return target.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def new_rows(target: DataFrame, incoming: DataFrame, keys: list, order) -> DataFrame:
    """Rows that ON CONFLICT DO NOTHING would insert."""
    return first_per_nonnull_key(incoming, keys, order).join(target.select(*keys), keys, "left_anti")


def merge_ignore(target: DataFrame, incoming: DataFrame, keys: list, order) -> DataFrame:
    return target.unionByName(new_rows(target, incoming, keys, order), allowMissingColumns=True)


def valid_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is a 64-bit integer; the key is returned as bigint."""
    return df.withColumn(key, F.expr(f"try_cast({key} AS bigint)")).filter(F.col(key).isNotNull())


def merge_counts(target: DataFrame, incoming: DataFrame, keys: list) -> DataFrame:
    """inserted / duplicates / errors of an insert-ignore batch (errors = null key)."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    per_key = incoming.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    seen = target.select(*keys, F.lit(1).alias("hit")).distinct()
    inserted = F.when(F.col("hit").isNull(), 1).otherwise(0)
    counts = per_key.join(seen, keys, "left").select(
        inserted.alias("inserted"), (F.col("n") - inserted).alias("duplicates"), F.lit(0).alias("errors")
    )
    bad = incoming.filter(~known).select(
        F.lit(0).alias("inserted"), F.lit(0).alias("duplicates"), F.lit(1).alias("errors")
    )
    return counts.unionByName(bad).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("inserted", "duplicates", "errors")]
    )


def touched_partitions(target: DataFrame, incoming: DataFrame, partition: str, keys: list | None = None) -> DataFrame:
    """Target rows in partitions that a merge changes: those of the incoming rows and, where the partition is not among
    the keys, those in which an incoming key lies now (a row that moves must leave its old partition)."""
    values = incoming.select(partition)
    if keys and partition not in keys:
        values = values.unionByName(target.join(incoming.select(*keys).distinct(), keys, "left_semi").select(partition))
    p, values = F.col(partition), values.distinct()
    # the span of the values prunes partitions before the scan, the semi join picks among them
    span = values.agg(F.min(p).alias("lo"), F.max(p).alias("hi"))
    named = target.filter((p >= span.select("lo").scalar()) & (p <= span.select("hi").scalar())).join(values, partition, "left_semi")
    unnamed = target.filter(p.isNull() & values.agg(F.count_if(p.isNull()) > 0).scalar())
    return named.select(*target.columns).unionByName(unnamed)


def drop_partitions(spark, path: str, partition: str, values: DataFrame) -> None:
    """Delete the folders of partition values that have no rows left; the values are streamed, not gathered."""
    jvm = spark._jvm
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for r in values.select(F.col(partition).cast("string")).distinct().toLocalIterator():
        folder = jvm.org.apache.hadoop.fs.Path(path, names.getPartitionPathString(partition, r[0]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_partitions(path: str, rows: DataFrame, partition: str, touched: DataFrame, schema) -> None:
    """Replace exactly the partitions named by ``touched``; those without rows disappear.

    The rows are first written to a staging path, so the table is never overwritten while it is being read and a failed
    run can be repeated."""
    spark = rows.sparkSession
    staging, days = scratch_path(spark, "merge"), scratch_path(spark, "touched")
    touched.select(partition).distinct().write.mode("error").parquet(days)
    rows.select(*schema.names).write.mode("error").parquet(staging)
    staged = spark.read.schema(schema).parquet(staging)
    (staged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))
    left = staged.select(F.col(partition).alias("__p")).distinct()
    gone = spark.read.parquet(days)
    drop_partitions(spark, path, partition, gone.join(left, gone[partition].eqNullSafe(left["__p"]), "left_anti"))


def merge_into_table(path: str, incoming: DataFrame, keys: list, order, partition: str, mode: str = "update") -> None:
    """Merge into a parquet table partitioned by ``partition``.

    Only partitions that change are read and replaced.  A key keeps one row also when its partition changes."""
    spark = incoming.sparkSession
    target = spark.read.parquet(path)
    incoming = materialize(incoming)
    current = touched_partitions(target, incoming, partition, keys)
    merge = merge_update if mode == "update" else merge_ignore
    touched = current.select(partition).unionByName(incoming.select(partition))
    replace_partitions(path, merge(current, incoming, keys, order), partition, touched, target.schema)


def append_new(path: str, incoming: DataFrame, keys: list, order, partition: str) -> None:
    """Append-only insert-ignore: no rewrite of existing files."""
    spark = incoming.sparkSession
    target = spark.read.parquet(path)
    incoming = materialize(incoming)
    known = target.select(*dict.fromkeys([partition, *keys]))
    current = touched_partitions(known, incoming, partition) if partition in keys else known
    new_rows(current, incoming, keys, order).write.mode("append").partitionBy(partition).parquet(path)


def changed_sets(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rows whose array columns differ as sets (null counts as empty)."""
    empty = F.array().cast("array<string>")
    as_set = lambda c: F.sort_array(F.array_distinct(F.coalesce(F.col(c), empty)))
    return df.filter(as_set(old) != as_set(new))


def remap_report(df: DataFrame, old: str, new: str) -> DataFrame:
    """(metric, value): rows changed, and distinct values before / after recomputing an array column."""
    changed = changed_sets(df, old, new).agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("changed_rows").alias("metric"), "value"
    )
    sides = [
        df.select(F.explode(c).alias("v")).agg(F.countDistinct("v").alias("value")).select(F.lit(m).alias("metric"), "value")
        for m, c in (("distinct_before", old), ("distinct_after", new))
    ]
    return changed.unionByName(sides[0]).unionByName(sides[1])
