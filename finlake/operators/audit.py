"""Audit log rows, change differences, audit report, record history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AsOf, ago, moment
from .lineage import contained_names

CHANGES = "map<string,struct<old_value:string,new_value:string>>"


def _log(df: DataFrame, user: Column, table: str, operation: str, tag: str, at: Column, **extra: Column) -> DataFrame:
    stamp = F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    row = extra.pop("row_key", F.lit(""))
    return df.select(
        F.sha2(F.concat(user, F.lit(table), F.lit(tag), stamp, row), 256).alias("id"),
        user.alias("user_id"),
        F.lit(table).alias("table_name"),
        F.lit(operation).alias("operation"),
        extra.get("filters", F.lit(None)).cast("map<string,string>").alias("filters"),
        extra.get("changes", F.lit(None)).cast(CHANGES).alias("changes"),
        extra.get("deleted_data", F.lit(None)).cast("map<string,string>").alias("deleted_data"),
        at.alias("timestamp"),
        F.lit(True).alias("success"),
    )


def changed_fields(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of either side with a map of the fields that differ; unchanged rows are left out.

    Rows that only one side has are changes even where all their fields are NULL.
    """
    names = list(dict.fromkeys(c for c in [*old.columns, *new.columns] if c not in keys))

    def side(df: DataFrame, alias: str) -> DataFrame:
        values = [
            (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in names
        ]
        return df.select(*keys, F.struct(*values).alias(alias))

    both = side(old, "o").join(side(new, "n"), list(keys), "full_outer")
    entries = [
        F.when(
            ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")),
            F.struct(
                F.lit(c).alias("key"),
                F.struct(F.col(f"o.{c}").alias("old_value"), F.col(f"n.{c}").alias("new_value")).alias("value"),
            ),
        )
        for c in names
    ]
    changes = F.map_from_entries(F.array_compact(F.array(*entries)))
    gone, added = F.col("n").isNull(), F.col("o").isNull()
    action = F.when(gone, "DELETE").when(added, "INSERT").otherwise("MODIFY").alias("acao")
    return both.where(gone | added | (F.size(changes) > 0)).select(*keys, action, changes.alias("changes"))


def long_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per changed field."""
    return changes.select(*keys, "acao", F.explode("changes").alias("campo", "v")).select(
        *keys, "acao", "campo", "v.old_value", "v.new_value"
    )


def audit_modifications(
    old: DataFrame, new: DataFrame, keys: Sequence[str], table: str, user: str, as_of: AsOf = None
) -> DataFrame:
    """MODIFY rows of the log for everything that differs between two copies of a table."""
    changes = changed_fields(old, new, keys)
    row_key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return _log(
        changes, F.lit(user), table, "MODIFY", "modify", moment(as_of), changes=F.col("changes"), row_key=row_key
    )


def audit_deletions(deleted: DataFrame, keys: Sequence[str], table: str, user: str, as_of: AsOf = None) -> DataFrame:
    image = F.map_from_arrays(
        F.array(*[F.lit(c) for c in deleted.columns]), F.array(*[F.col(c).cast("string") for c in deleted.columns])
    )
    row_key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return _log(
        deleted, F.lit(user), table, "DELETE", "delete", moment(as_of), deleted_data=image, row_key=row_key
    )


def audit_access(accesses: DataFrame, table: str, operation: str = "SELECT") -> DataFrame:
    """Log rows for accesses (user_id, timestamp, optional filters map)."""
    filters = F.col("filters") if "filters" in accesses.columns else F.create_map().cast("map<string,string>")
    return _log(accesses, F.col("user_id").cast("string"), table, operation, operation, F.col("timestamp"), filters=filters)


def in_period(log: DataFrame, start: AsOf = None, end: AsOf = None) -> DataFrame:
    """Log rows between the bounds, both included; the last 30 days by default."""
    until = moment(end)
    since = ago("30 days", end) if start is None else moment(start)
    return log.where(F.col("timestamp").between(since, until))


def audit_report(log: DataFrame, start: AsOf = None, end: AsOf = None) -> DataFrame:
    """(dimensao, chave, total) rows: all operations, by type, by user, by table, in one pass."""
    sets = [[], ["operation"], ["user_id"], ["table_name"]]
    counted = (
        in_period(log, start, end)
        .groupingSets(sets, "operation", "user_id", "table_name")
        .agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("total"))
    )
    g = F.col("g")
    dimension = F.when(g == 7, "total_operations").when(g == 3, "operation").when(g == 5, "user_id").otherwise("table_name")
    value = F.when(g == 3, F.col("operation")).when(g == 5, F.col("user_id").cast("string")).when(g == 6, F.col("table_name"))
    return counted.select(dimension.alias("dimensao"), value.alias("chave"), "total")


def record_lineage(log: DataFrame, table: str, record_id: str) -> DataFrame:
    """Log rows of the table whose changes or deleted data mention the id."""

    def mentions(column: str) -> Column:
        if column not in log.columns:
            return F.lit(False)
        value = F.col(column)
        text = value if log.schema[column].dataType.typeName() == "string" else F.to_json(value)
        return F.coalesce(text.contains(record_id), F.lit(False))

    return log.where((F.col("table_name") == table) & (mentions("changes") | mentions("deleted_data")))


def records_lineage(log: DataFrame, records: DataFrame, table: str, record: str = "record_id", key: str = "id") -> DataFrame:
    """``record_lineage`` of many records at once: (record, key) of the table's log rows that mention it.

    The log's words are indexed once, whatever the number of records.
    """
    texts = [F.col(c) if log.schema[c].dataType.typeName() == "string" else F.to_json(c) for c in ("changes", "deleted_data") if c in log.columns]
    rows = log.where(F.col("table_name") == table).select(key, F.explode(F.array(*texts)).alias("_text"))
    return contained_names(rows, records, key, "_text", record, ignore_case=False)
