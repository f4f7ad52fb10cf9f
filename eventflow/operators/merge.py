"""Keyed upserts where a null never overwrites a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.session import stored


def case_insensitive(df: DataFrame, columns: list[str]) -> DataFrame:
    """Match fields to target columns by name ignoring case; unmatched ones are dropped."""
    by_name = {c.lower(): c for c in df.columns}
    return df.select(
        *[F.col(by_name[c.lower()]).alias(c) for c in columns if c.lower() in by_name]
    )


def insert_rows(df: DataFrame, target_schema) -> DataFrame:
    """Rows to insert: mapped fields converted to the column types, empty rows dropped.

    A null field is simply not set (the column default applies at the store).
    """
    fields = {f.name: f.dataType for f in target_schema.fields}
    mapped = case_insensitive(df, list(fields))
    if not mapped.columns:
        return mapped.limit(0)
    typed = mapped.select(*[F.col(c).cast(fields[c]).alias(c) for c in mapped.columns])
    return typed.dropna(how="all")


def _order(order: list[str]) -> Column:
    # Within a struct a null compares as the earliest; a bare null would drop the row.
    return F.struct(*order)


def fold_updates(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: for each column the last non-null value in event order.

    Columns of the order are values like the others; a null in them comes first.
    ``max_by`` combines on the map side, so a key with very many updates sends one
    partial row per task to its reducer.
    """
    values = [c for c in updates.columns if c not in keys]
    if not values:
        return updates.select(*keys).distinct()
    position = _order(order)
    return updates.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in values]
    )


def merge_upsert(
    target: DataFrame, updates: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Target after inserting new keys and updating known ones with non-null fields."""
    folded = fold_updates(updates, keys, order)
    fields = [c for c in folded.columns if c not in keys and c in target.columns]
    u = folded.select(
        *[F.col(k).alias(f"_u_{k}") for k in keys], *[F.col(c).alias(f"_u_{c}") for c in fields]
    )
    same = [F.col(k) == F.col(f"_u_{k}") for k in keys]
    # Not one full join, which would shuffle the whole target whatever the updates are:
    # Spark can broadcast a small side of each of these.
    updated = target.join(u, same, "left").select(*[
        F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in target.columns
    ])
    known = target.select(*keys).join(u, same, "left_semi").select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    fresh = u.join(known, [F.col(f"_u_{k}") == F.col(f"_k_{k}") for k in keys], "left_anti")
    types = {f.name: f.dataType for f in target.schema.fields}
    inserted = fresh.select(*[
        (F.col(f"_u_{c}") if c in keys or c in fields else F.lit(None)).cast(types[c]).alias(c) for c in target.columns
    ])
    return updated.unionByName(inserted)


def upsert_table(
    spark: SparkSession, path: str, updates: DataFrame, keys: list[str], order: list[str], partition_by: list[str],
    *, fmt: str = "parquet",
) -> int:
    """``merge_upsert`` into a partitioned table, rewriting only the partitions that change.

    An update whose key is stored goes to that row's partition; a new key needs its
    partition columns set, in the updates, and goes there. A stored row keeps its
    partition: a partition column is never updated. The keys of the table are read to find
    those partitions (filtered by the key range of the updates, so files outside it are
    skipped), then only they are read, merged, written aside and put in place by a dynamic
    overwrite. Returns the number of partitions written; no updates write none. The updates
    are folded once. One writer at a time.
    """
    folded = stored(fold_updates(updates, keys, order), "upsert-updates")
    bounds = folded.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    if all(v is None for v in bounds):
        return 0
    table = spark.read.format(fmt).load(path)
    near = F.lit(True)
    for k in keys:
        near = near & F.col(k).between(F.lit(bounds[f"min_{k}"]), F.lit(bounds[f"max_{k}"]))
    held = table.where(near).select(*keys, *partition_by)
    found = stored(held.join(folded.select(*keys), keys, "left_semi"), "upsert-found")
    fresh = folded.join(found.select(*keys), keys, "left_anti")
    touched = found.select(*partition_by).union(fresh.select(*partition_by)).distinct()
    values = [tuple(r) for r in touched.collect()]  # partitions, as the writer's commit lists them
    if not values:
        return 0
    types = [table.schema[c].dataType for c in partition_by]
    chosen = F.lit(False)
    for row in values:
        part = F.lit(True)
        for c, t, v in zip(partition_by, types, row):
            part = part & F.col(c).eqNullSafe(F.lit(v).cast(t))
        chosen = chosen | part
    # A stored row's partition wins over the updates' one.
    kept = folded.drop(*partition_by).join(found, keys, "left")
    given = folded.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in partition_by])
    moved = kept.join(given, keys).withColumns({c: F.coalesce(F.col(c), F.col(f"_new_{c}")) for c in partition_by})
    moved = moved.drop(*[f"_new_{c}" for c in partition_by])
    merged = stored(merge_upsert(table.where(chosen), moved, keys, keys), "upsert-merged")
    merged.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by
    ).save(path)
    return len(values)


def update_or_insert(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    order: list[str],
    where: list[str] = (),
) -> DataFrame:
    """Folded updates with an ``action``: ``update`` when the key exists, else ``insert``.

    ``where`` columns are not set by an update: they must equal the stored value, and
    an update whose ``where`` values differ touches nothing (action ``skip``).
    """
    folded = fold_updates(updates, [key], order)
    folded = folded.drop(*[c for c in order if c != key and c not in target.columns])
    stored = target.select(
        F.col(key).alias("_k"), F.lit(True).alias("_found"), *[F.col(c).alias(f"_w_{c}") for c in where]
    )
    joined = folded.join(stored, folded[key] == F.col("_k"), "left")
    agrees = F.lit(True)
    for c in where:
        agrees = agrees & (F.col(c).isNull() | F.col(c).eqNullSafe(F.col(f"_w_{c}")))
    action = (
        F.when(F.col("_found").isNull(), F.lit("insert"))
        .when(agrees, F.lit("update"))
        .otherwise(F.lit("skip"))
    )
    return joined.withColumn("action", action).drop("_k", "_found", *[f"_w_{c}" for c in where])


def apply_updates(
    target: DataFrame, updates: DataFrame, key: str, order: list[str], where: list[str] = ()
) -> DataFrame:
    """Target after ``update_or_insert``: the target is read and joined once for updates."""
    folded = fold_updates(updates, [key], order)
    fields = [c for c in folded.columns if c != key and c in target.columns]
    given = folded.select(F.col(key).alias("_u"), *[F.col(c).alias(f"_u_{c}") for c in dict.fromkeys([*fields, *where])])
    agrees = F.lit(True)
    for c in where:
        agrees = agrees & (F.col(f"_u_{c}").isNull() | F.col(f"_u_{c}").eqNullSafe(F.col(c)))
    joined = target.join(given, F.col(key) == F.col("_u"), "left")
    updated = joined.select(*[
        F.when(agrees, F.coalesce(F.col(f"_u_{c}"), F.col(c))).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in target.columns
    ])
    known = target.select(F.col(key).alias("_k")).join(given, F.col("_k") == F.col("_u"), "left_semi")
    fresh = given.join(known, F.col("_u") == F.col("_k"), "left_anti")
    types = {f.name: f.dataType for f in target.schema.fields}
    inserted = fresh.select(*[
        (F.col("_u") if c == key else F.col(f"_u_{c}") if c in fields else F.lit(None)).cast(types[c]).alias(c)
        for c in target.columns
    ])
    return updated.unionByName(inserted)
