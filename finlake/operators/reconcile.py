"""Reconciliation of two copies of the ledger."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AsOf, ago, divergence_pct
from ..functions.frames import side_by_side

LIMIT_PCT = 0.01
# Tables compared and the column summed in each.
VALUE_COLUMNS = {"contas": "saldo", "clientes": None, "transacoes": "valor"}


def _of(side: str, name: str) -> Column:
    return F.sum(F.when(F.col("lado") == side, F.col(name)))


def reconcile_totals(
    core: Mapping[str, DataFrame],
    lake: Mapping[str, DataFrame],
    value_columns: Mapping[str, str | None] = VALUE_COLUMNS,
    limit_pct: float = LIMIT_PCT,
) -> DataFrame:
    """Per table: count and sum on both sides, greatest divergence, whether it is over the limit.

    A table that is missing on a side, or lacks its value column, is an error and diverges.
    """
    sides, errors = [], {}
    for table, column in value_columns.items():
        for side, tables in (("core", core), ("lake", lake)):
            df = tables.get(table)
            if df is None or (column and column not in df.columns):
                errors[table] = f"{table}: not readable on side {side}"
                continue
            total = F.coalesce(F.sum(column).cast("double"), F.lit(0.0)) if column else F.lit(None).cast("double")
            row = df.agg(F.count(F.lit(1)).alias("n"), total.alias("valor"))
            sides.append(row.select(F.lit(table).alias("tabela"), F.lit(side).alias("lado"), "n", "valor"))
    if not sides:
        raise ValueError("no table is readable on either side")
    merged = reduce(DataFrame.unionByName, sides).groupBy("tabela").agg(
        _of("core", "n").alias("core_total"), _of("lake", "n").alias("lake_total"),
        _of("core", "valor").alias("core_valor"), _of("lake", "valor").alias("lake_valor"),
    )
    error = reduce(
        lambda acc, item: F.when(F.col("tabela") == item[0], F.lit(item[1])).otherwise(acc),
        errors.items(),
        F.lit(None).cast("string"),
    )
    # greatest() skips NULL, so a table without a value column is judged by its count alone.
    worst = F.greatest(
        divergence_pct(F.col("core_total"), F.col("lake_total")),
        F.when(F.col("core_valor").isNotNull(), divergence_pct(F.col("core_valor"), F.col("lake_valor"))),
    )
    out = merged.withColumn("erro", error).withColumn("divergencia_pct_max", F.when(F.col("erro").isNull(), worst))
    return out.withColumn("diverge", F.col("erro").isNotNull() | (F.col("divergencia_pct_max") > limit_pct))


def daily_summary(df: DataFrame, ts: str, value: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("dia")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(value), F.lit(0)).cast("double").alias("valor")
    )


def reconcile_daily(
    core: DataFrame,
    lake: DataFrame,
    days: int = 7,
    as_of: AsOf = None,
    ts: str = "data_atualizacao",
    value: str = "valor",
    limit_pct: float = LIMIT_PCT,
    compare_sum: bool = False,
) -> DataFrame:
    """Transactions per day on both sides, by day; a day only one side has counts as 0 on the other."""
    since = ago(f"{days} days", as_of)

    def side(df: DataFrame, prefix: str) -> DataFrame:
        summary = daily_summary(df.where(F.col(ts) >= since), ts, value)
        return summary.select("dia", F.col("n").alias(f"{prefix}_n"), F.col("valor").alias(f"{prefix}_valor"))

    joined = side(core, "core").join(side(lake, "lake"), "dia", "full_outer")
    joined = joined.fillna(0, ["core_n", "lake_n"]).fillna(0.0, ["core_valor", "lake_valor"])
    pct = divergence_pct(F.col("core_n"), F.col("lake_n"))
    if compare_sum:
        pct = F.greatest(pct, divergence_pct(F.col("core_valor"), F.col("lake_valor")))
    rows = joined.withColumn("divergencia_pct", pct).withColumn("diverge", F.col("divergencia_pct") > limit_pct)
    return rows.orderBy("dia")


def reconcile_external(
    consolidated: DataFrame, lake: DataFrame, value: str = "valor", limit_pct: float = LIMIT_PCT
) -> DataFrame:
    """External settlement total (quantidade, valor) against the lake's own PIX."""
    ours = lake.agg(
        F.count(F.lit(1)).alias("lake_n"), F.coalesce(F.sum(value), F.lit(0)).cast("double").alias("lake_valor")
    )
    theirs = consolidated.agg(
        F.sum("quantidade").alias("spi_n"), F.sum("valor").cast("double").alias("spi_valor")
    )
    pct = F.greatest(
        divergence_pct(F.col("spi_n"), F.col("lake_n")), divergence_pct(F.col("spi_valor"), F.col("lake_valor"))
    )
    out = side_by_side(theirs, ours).withColumn("divergencia_pct", pct)
    return out.withColumn("diverge", F.coalesce(F.col("divergencia_pct") > limit_pct, F.lit(True)))


def divergence_metrics(reports: Mapping[str, DataFrame], ran_at: AsOf = None) -> DataFrame:
    """Per scope and overall: divergences, greatest percentage, ok flag.

    Each report has a ``diverge`` flag and a percentage column (``divergencia_pct_max`` or
    ``divergencia_pct``). Any divergence puts the greatest percentage at 100 or more.
    """
    rows = []
    for scope, report in reports.items():
        pct = "divergencia_pct_max" if "divergencia_pct_max" in report.columns else "divergencia_pct"
        rows.append(report.select(F.lit(scope).alias("escopo"), "diverge", F.col(pct).alias("pct")))
    flagged = F.count_if(F.col("diverge"))
    worst = F.coalesce(F.greatest(F.max("pct"), F.when(flagged > 0, F.lit(100.0))), F.lit(0.0))
    merged = reduce(DataFrame.unionByName, rows).rollup("escopo").agg(
        flagged.alias("divergencias"), worst.alias("divergencia_pct")
    )
    out = merged.select(
        F.coalesce("escopo", F.lit("global")).alias("escopo"),
        "divergencias",
        "divergencia_pct",
        F.when(F.col("divergencias") == 0, 1.0).otherwise(0.0).alias("ok"),
    )
    if ran_at is not None:
        out = out.withColumn("ultima_execucao", F.unix_seconds(F.lit(str(ran_at)).cast("timestamp")))
    return out


def assert_no_divergence(report: DataFrame, name: str) -> None:
    """Raises when the report has a divergence. Reads at most a few rows."""
    found = report.where("diverge").take(5)
    if found:
        raise RuntimeError(f"divergences in {name}: {[r.asDict() for r in found]}")
