"""Keyed writes on immutable tables: every operator returns the new version of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from humusgrid.operators.components import connected_components


def _newest(changes: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """One row a key: the newest by `order`, of equally new ones (or without an order) the largest by all columns.

    A maximum of structs combines on the map side, so a hot key is no hot task.
    """
    rest = [c for c in changes.columns if c not in keys and c != order]
    columns = [order, *rest] if order else rest
    if not columns:
        return changes.distinct()
    best = changes.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("_m"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_m.{c}").alias(c) for c in changes.columns])


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str | None = None, keep_old_where_null: bool = False) -> DataFrame:
    """Rows of changes overwrite the listed columns of rows with their key, other rows are added.

    Of several changes of a key the newest by `order` counts. keep_old_where_null:
    a null in the change keeps the stored value.
    """
    new = _newest(changes, keys, order).select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_is_new"))
    joined = target.withColumn("_is_old", F.lit(True)).join(new, list(keys), "full")
    out = []
    for c in target.columns:
        if c in columns:
            given = F.col("_is_new") & F.col(f"_new_{c}").isNotNull() if keep_old_where_null else F.col("_is_new")
            out.append(F.when(F.coalesce(given, F.lit(False)), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def insert_missing(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new keys are added, stored rows stay."""
    return target.unionByName(_newest(rows, keys, None).join(target.select(*keys), list(keys), "left_anti").select(*target.columns))


def replace_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows of the keys are replaced as a whole."""
    return target.join(rows.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))


def delete_rows(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def final_survivors(log: DataFrame, retired: str, canonical: str) -> DataFrame:
    """(id, survivor) of every id of a merge log, over chains of any length.

    The survivor is the id of the connected group that is never retired; the
    smallest one where there are several, and the smallest id of the group where
    all are (a loop). Rows with a null side, and of an id onto itself, retire
    nothing.
    """
    rows = log.select(F.col(retired).alias("a"), F.col(canonical).alias("b"))
    groups = connected_components(rows, "a", "b")
    gone = rows.filter("a is not null and b is not null and a <> b").select(F.col("a").alias("id"), F.lit(True).alias("gone")).distinct()
    marked = groups.join(gone, "id", "left")
    best = marked.groupBy("component").agg(F.coalesce(F.min(F.when(F.col("gone").isNull(), F.col("id"))), F.min("id")).alias("survivor"))
    return groups.join(best, "component").select("id", "survivor")


def redirect_key(target: DataFrame, column: str, log: DataFrame, retired: str, canonical: str) -> DataFrame:
    """References to retired ids point to their canonical ids; of several canonical ids of one id the smallest counts."""
    to = log.filter(F.col(retired).isNotNull()).groupBy(F.col(retired).alias("_from")).agg(F.min(canonical).alias("_to"))
    return target.join(to, target[column] == F.col("_from"), "left").withColumn(column, F.coalesce("_to", column)).select(*target.columns)


def with_history(target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(new version, replaced rows): an upsert that keeps what it overwrites."""
    return upsert(target, changes, keys, columns), target.join(changes.select(*keys).distinct(), list(keys), "left_semi")


def zero_counts(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, rows) of tables that should be empty, and `ready` where all of them are."""
    out = None
    for name, df in checks.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("check"), "rows")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("ready", F.max("rows").over(Window.partitionBy()) == 0)


def conditional_upsert(target: DataFrame, changes: DataFrame, key: str, keep: Column, columns: Sequence[str]) -> DataFrame:
    """An upsert by which rows that satisfy `keep` stay as they are; a null in a change keeps the stored value."""
    new = _newest(changes.select(key, *columns), [key], None)
    return upsert(target.filter(~F.coalesce(keep, F.lit(False))), new.join(target.filter(keep).select(key), key, "left_anti"), [key], columns, keep_old_where_null=True).unionByName(target.filter(keep))


def fill_from_first(target: DataFrame, source: DataFrame, key: str, column: str, value: str, order: str) -> DataFrame:
    """column set to the first value (by order) that source has for the key, where it has any."""
    first = source.filter(F.col(value).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(F.struct(order, value))[value].alias("_first"))
    return target.join(first, F.col(key) == F.col("_k"), "left").withColumn(column, F.coalesce("_first", column)).select(*target.columns)


def delete_where(tables: dict[str, DataFrame], gone: Column, parent: str, key: str, children: Sequence[str]) -> dict[str, DataFrame]:
    """Tables without the parent rows that satisfy `gone`, and without the children's rows of their keys."""
    keys = tables[parent].filter(gone).select(key).distinct()
    kept = {parent: tables[parent].filter(~F.coalesce(gone, F.lit(False)))}
    return tables | kept | {c: tables[c].join(keys, key, "left_anti") for c in children}


def sweep_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child whose key has a parent; null keys refer to nothing and stay."""
    held = parent.select(F.col(key).alias("_k")).filter("_k is not null").distinct()
    return child.join(held, F.col(key) == F.col("_k"), "left").filter(F.col("_k").isNotNull() | F.col(key).isNull()).drop("_k")


def rename_value(tables: dict[str, DataFrame], column: str, names: dict[str, str]) -> dict[str, DataFrame]:
    """Every table that has the column with its values renamed; names come from the tables' own schemas."""
    to = lambda c: F.coalesce(*[F.when(F.col(c) == old, F.lit(new)) for old, new in names.items()], F.col(c))
    return {name: df.withColumn(column, to(column)) if column in df.columns else df for name, df in tables.items()}


def with_column_added(df: DataFrame, column: str, kind: str, default: object = None) -> DataFrame:
    """df with the column, added with its default where it is missing."""
    return df if column in df.columns else df.withColumn(column, F.lit(default).cast(kind))


def downgrade(df: DataFrame, status: str, old: str, new: str, notes: str, note: str, where: Column) -> DataFrame:
    """Rows still in the old state that satisfy `where` get the new one and the note appended."""
    hit = F.coalesce((F.col(status) == old) & where, F.lit(False))
    return df.withColumn(notes, F.when(hit, F.concat_ws(" ", notes, F.lit(note))).otherwise(F.col(notes))).withColumn(status, F.when(hit, new).otherwise(F.col(status)))
