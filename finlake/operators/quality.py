"""Data-quality suites.

All checks of a table that compare a row with constants are one aggregate over one scan. Checks
that list values (uniqueness, value sets) give (check, value) pairs that are counted together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
REGEX = "expect_column_values_to_match_regex"
BETWEEN = "expect_column_values_to_be_between"
ROW_COUNT = "expect_table_row_count_to_be_between"
LENGTH = "expect_column_value_lengths_to_be_between"
PAIR_GREATER = "expect_column_pair_values_A_to_be_greater_than_B"

SAMPLE_SIZE = {UNIQUE: 5, IN_SET: 10}


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    args: Mapping = field(default_factory=dict)

    def columns(self) -> list[str]:
        if self.kind == PAIR_GREATER:
            return [self.args["column_A"], self.args["column_B"]]
        return [self.column] if self.column else []


def not_null(column: str) -> Expectation:
    return Expectation(NOT_NULL, column)


def unique(column: str) -> Expectation:
    return Expectation(UNIQUE, column)


def in_set(column: str, *values: str) -> Expectation:
    return Expectation(IN_SET, column, {"value_set": list(values)})


def matches(column: str, regex: str) -> Expectation:
    return Expectation(REGEX, column, {"regex": regex})


def between(column: str, low: float, high: float) -> Expectation:
    return Expectation(BETWEEN, column, {"min_value": low, "max_value": high})


def row_count(low: int, high: int) -> Expectation:
    return Expectation(ROW_COUNT, None, {"min_value": low, "max_value": high})


def length_between(column: str, low: int, high: int) -> Expectation:
    return Expectation(LENGTH, column, {"min_value": low, "max_value": high})


def pair_greater(a: str, b: str) -> Expectation:
    return Expectation(PAIR_GREATER, None, {"column_A": a, "column_B": b})


# The expectation suites of the five core tables.
SUITES: dict[str, list[Expectation]] = {
    "contas": [
        not_null("id"),
        not_null("cliente_id"),
        not_null("tipo_conta"),
        unique("id"),
        in_set("tipo_conta", "CORRENTE", "POUPANCA", "SALARIO", "INVESTIMENTO"),
        in_set("status", "ATIVA", "INATIVA", "BLOQUEADA", "ENCERRADA"),
        unique("numero_conta"),
        matches("numero_conta", r"^\d{6,12}$"),
        between("saldo", -100000, 10000000),
        row_count(1, 10000000),
        not_null("tenant_id"),
        length_between("tenant_id", 1, 50),
    ],
    "clientes": [
        not_null("id"),
        unique("id"),
        not_null("nome_completo"),
        matches("cpf", r"^\d{11}$"),
        unique("cpf"),
        matches("email", r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"),
        matches("telefone", r"^\d{10,11}$"),
        in_set("tipo_pessoa", "PF", "PJ"),
        in_set("status", "ATIVO", "INATIVO", "BLOQUEADO", "PENDENTE_KYC"),
        not_null("data_nascimento"),
        matches("cnpj", r"^\d{14}$"),
    ],
    "transacoes": [
        not_null("id"),
        unique("id"),
        not_null("conta_id"),
        not_null("tipo_transacao"),
        in_set(
            "tipo_transacao", "PIX_ENVIADO", "PIX_RECEBIDO", "TED_ENVIADO", "TED_RECEBIDO", "DOC_ENVIADO",
            "DOC_RECEBIDO", "DEPOSITO", "SAQUE", "TRANSFERENCIA", "PAGAMENTO", "TARIFA", "RENDIMENTO",
        ),
        in_set("status", "PENDENTE", "PROCESSADA", "CANCELADA", "FALHOU", "ESTORNADA"),
        between("valor", 0.01, 50000000),
        not_null("data_transacao"),
        matches("canal", "^(MOBILE|WEB|CORRETORA|API|BACKOFFICE|ATM)$"),
        pair_greater("data_transacao", "created_at"),
        not_null("tenant_id"),
    ],
    "pix_pagamentos": [
        not_null("id"),
        not_null("chave_pix"),
        in_set("tipo_chave_pix", "CPF", "CNPJ", "EMAIL", "TELEFONE", "CHAVE_ALEATORIA"),
        between("valor", 0.01, 50000000),
        in_set("status", "PENDENTE", "CONFIRMADA", "FALHOU", "CANCELADA", "DEVOLVIDA"),
        not_null("ispb_origem"),
        not_null("ispb_destino"),
    ],
    "credito_solicitacoes": [
        not_null("id"),
        in_set(
            "tipo_credito", "CONSIGNADO", "FINANCIAMENTO", "CREDITO_PESSOAL", "CARTAO_CREDITO", "CHEQUE_ESPECIAL"
        ),
        between("valor_solicitado", 100, 5000000),
        between("prazo_meses", 1, 360),
        in_set(
            "status", "SOLICITADO", "EM_ANALISE", "APROVADO", "REPROVADO", "LIBERADO", "CONTRATO_ASSINADO",
            "LIQUIDADO",
        ),
    ],
}

RESULT_SCHEMA = (
    "tabela string, posicao int, expectativa string, coluna string, passou boolean, falhas long, "
    "total_linhas long, amostra array<string>, erro string, detalhes string"
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _failing_rows(df: DataFrame, e: Expectation) -> str | None:
    """Count of failing rows for checks on single rows; NULL values pass except in not_null.

    A text that is no number lies outside every range.
    """
    low, high = e.args.get("min_value"), e.args.get("max_value")
    if e.kind == NOT_NULL:
        failing = f"`{e.column}` IS NULL"
    elif e.kind == REGEX:
        failing = f"NOT CAST(`{e.column}` AS STRING) RLIKE {_quoted(e.args['regex'])}"
    elif e.kind == BETWEEN and df.schema[e.column].dataType == T.StringType():
        number = f"try_cast(`{e.column}` AS DOUBLE)"
        failing = f"`{e.column}` IS NOT NULL AND coalesce(NOT {number} BETWEEN {low} AND {high}, true)"
    elif e.kind == BETWEEN:
        failing = f"`{e.column}` < {low} OR `{e.column}` > {high}"
    elif e.kind == LENGTH:
        failing = f"NOT length(CAST(`{e.column}` AS STRING)) BETWEEN {low} AND {high}"
    elif e.kind == PAIR_GREATER:
        failing = f"NOT (`{e.args['column_A']}` > `{e.args['column_B']}`)"
    else:
        return None
    return f"count_if({failing})"


def _listed_values(df: DataFrame, checks: Mapping[int, Expectation]) -> DataFrame | None:
    """(posicao, valor) pairs that break a uniqueness or value-set check, each once.

    All columns to be listed are read in one scan, as one narrow row per check; of a value set only invalid values leave.
    Rows are counted by check and value, on the map side first.
    """
    entries, unique_checks = [], []
    for i, e in checks.items():
        if e.kind not in (UNIQUE, IN_SET):
            continue
        column = F.col(f"`{e.column}`")
        if df.schema[e.column].dataType in (T.DoubleType(), T.FloatType()):
            column = F.when(column == 0, F.lit(0.0)).otherwise(column)  # one zero, as groups have it
        value = column.cast("string")
        pair = F.struct(F.lit(i).alias("posicao"), value.alias("valor"))
        if e.kind == UNIQUE:
            unique_checks.append(i)
            entries.append(pair)
        else:
            entries.append(F.when(value.isNotNull() & ~value.isin(*e.args["value_set"]), pair))
    if not entries:
        return None
    counted = df.select(F.inline(F.array_compact(F.array(*entries)))).groupBy("posicao", "valor").agg(F.count(F.lit(1)).alias("_n"))
    return counted.where((F.col("_n") > 1) | ~F.col("posicao").isin(*unique_checks)).drop("_n")


def _listed_results(listed: DataFrame, checks: Mapping[int, Expectation], samples: bool) -> list[DataFrame]:
    """Number of listed values per check, and the first few of them in order."""
    counts = listed.groupBy("posicao").agg(F.count(F.lit(1)).alias("n"))
    if not samples:
        return [counts]
    rank = F.row_number().over(Window.partitionBy("posicao").orderBy("valor"))
    first = listed.withColumn("rn", rank).where(F.col("rn") <= max(SAMPLE_SIZE.values()))
    unique_checks = [i for i, e in checks.items() if e.kind == UNIQUE]
    size = F.when(F.col("posicao").isin(unique_checks), SAMPLE_SIZE[UNIQUE]).otherwise(SAMPLE_SIZE[IN_SET])
    shown = first.where(F.col("rn") <= size).groupBy("posicao")
    return [counts, shown.agg(F.sort_array(F.collect_list(F.coalesce("valor", F.lit("None")))).alias("amostra"))]


def _planned(df: DataFrame, expectations: Sequence[Expectation]) -> tuple[dict[int, str], dict[int, Expectation], dict[int, str]]:
    """Errors of checks that cannot run, the checks that can, and the counts of those on single rows."""
    errors: dict[int, str] = {}
    checks: dict[int, Expectation] = {}
    known = {NOT_NULL, UNIQUE, IN_SET, REGEX, BETWEEN, ROW_COUNT, LENGTH, PAIR_GREATER}
    for i, e in enumerate(expectations):
        missing = [c for c in e.columns() if c not in df.columns]
        if e.kind not in known:
            errors[i] = f"unknown expectation {e.kind}"
        elif missing:
            errors[i] = f"missing column {', '.join(missing)}"
        else:
            checks[i] = e

    scalars = {}
    for i, e in list(checks.items()):
        try:
            if (count := _failing_rows(df, e)) is not None:
                df.selectExpr(count).schema  # noqa: B018 - analysis only
                scalars[i] = count
        except AnalysisException as error:
            errors[i] = str(error).splitlines()[0]
            del checks[i]
    return errors, checks, scalars


def _counts(scalars: Mapping[int, str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total"), *[F.expr(c).alias(f"c{i}") for i, c in scalars.items()]]


def run_suite(df: DataFrame, table: str, expectations: Sequence[Expectation], samples: bool = True) -> DataFrame:
    """One result row per expectation. A check that cannot run is a failed result with its error.

    Without ``samples`` listed values are only counted.
    """
    errors, checks, scalars = _planned(df, expectations)
    totals = df.agg(*_counts(scalars))
    return _suite_results(table, expectations, errors, checks, scalars, totals, _listed_values(df, checks), samples)


def write_checked(
    df: DataFrame, table: str, expectations: Sequence[Expectation], write: Callable[[DataFrame], DataFrame], layer: str,
    samples: bool = True,
) -> DataFrame:
    """Write a layer and check it in the same pass: the results of ``run_suite``, or an error when a check fails.

    ``write`` runs the write and returns the written layer. Checks on single rows are counted while the rows pass by.
    Of the written layer only columns that must be unique are read again, and those in which a value outside its set was
    met, to list the values.
    """
    errors, checks, scalars = _planned(df, expectations)
    outside = {
        i: F.count_if(~F.col(f"`{e.column}`").cast("string").isin(*e.args["value_set"])).alias(f"s{i}")
        for i, e in checks.items() if e.kind == IN_SET
    }
    observation = Observation()
    written = write(df.observe(observation, *_counts(scalars), *outside.values()))
    names = ["total", *[f"c{i}" for i in scalars]]
    # Spark plans the rows away where it knows that there are none, and nothing is observed then.
    seen = dict.fromkeys(names, 0) if written.isEmpty() else observation.get
    totals = df.sparkSession.createDataFrame([tuple(seen[n] for n in names)], ", ".join(f"{n} long" for n in names))
    listed = {i: e for i, e in checks.items() if e.kind == UNIQUE or seen.get(f"s{i}")}
    results = _suite_results(table, expectations, errors, checks, scalars, totals, _listed_values(written, listed), samples)
    assert_quality(results, layer)
    return results


def _suite_results(
    table: str, expectations: Sequence[Expectation], errors: Mapping[int, str], checks: Mapping[int, Expectation],
    scalars: Mapping[int, str], totals: DataFrame, listed: DataFrame | None, samples: bool,
) -> DataFrame:
    entries = []
    for i, e in enumerate(expectations):
        failed = "CAST(NULL AS BIGINT)"
        if i in scalars:
            failed = f"c{i}"
        elif i in checks and e.kind == ROW_COUNT:
            failed = f"CAST(total NOT BETWEEN {e.args['min_value']} AND {e.args['max_value']} AS BIGINT)"
        name = e.column or "/".join(e.columns())
        texts = [_quoted(t) if t else "CAST(NULL AS STRING)" for t in (table, e.kind, name, errors.get(i))]
        entries.append(
            f"named_struct('tabela', {texts[0]}, 'posicao', {i}, 'expectativa', {texts[1]}, 'coluna', {texts[2]}, "
            f"'falhas', {failed}, 'total_linhas', total, 'erro', {texts[3]})"
        )
    rows = totals.selectExpr(f"inline(array({', '.join(entries)}))")
    parts = [rows.withColumns({"n": F.lit(None).cast("long"), "amostra": F.lit(None).cast("array<string>")})]
    if listed is not None:
        parts += _listed_results(listed, checks, samples)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rows = stacked.groupBy("posicao").agg(*[F.max(c).alias(c) for c in stacked.columns if c != "posicao"])
    failures = F.coalesce("falhas", "n", F.lit(0))
    passed = F.col("erro").isNull() & (failures == 0)
    details = (
        F.when(F.col("erro").isNotNull(), F.col("erro"))
        .when(passed, F.lit("OK"))
        .when(F.col("expectativa") == ROW_COUNT, F.concat(F.lit("Row count "), "total_linhas", F.lit(" fora do range")))
        .otherwise(F.concat(failures.cast("string"), F.lit(" falhas")))
    )
    return rows.select(
        "tabela", "posicao", "expectativa", "coluna", passed.alias("passou"), failures.cast("long").alias("falhas"),
        "total_linhas", F.coalesce("amostra", F.array().cast("array<string>")).alias("amostra"), "erro",
        details.alias("detalhes"),
    )


def run_all(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    wanted: Iterable[str] | None = None,
    suites: Mapping[str, Sequence[Expectation]] = SUITES,
    samples: bool = True,
) -> tuple[DataFrame, list[str]]:
    """Results of every wanted suite, and the names that were skipped (no such suite)."""
    names = list(wanted) if wanted is not None else [t for t in suites if t in tables]
    skipped = [n for n in names if n not in suites]
    results = []
    for name in names:
        if name in tables and name in suites:
            results.append(run_suite(tables[name], name, suites[name], samples))
        elif name in suites:
            rows = [(name, i, e.kind, e.column, False, 0, 0, [], "missing table", "missing table")
                    for i, e in enumerate(suites[name])]
            results.append(spark.createDataFrame(rows, RESULT_SCHEMA))
    if not results:
        return spark.createDataFrame([], RESULT_SCHEMA), skipped
    return reduce(DataFrame.unionByName, results), skipped


def quality_report(results: DataFrame) -> DataFrame:
    total, passed = F.count(F.lit(1)), F.count_if(F.col("passou"))
    return results.agg(
        total.alias("total_checks"),
        passed.alias("total_passed"),
        (total - passed).alias("total_failed"),
        F.when(total > 0, passed / total * 100).otherwise(0.0).alias("pass_rate"),
    )


def assert_quality(results: DataFrame, layer: str) -> None:
    """Gate between layers: raises when a check of the layer failed. Reads at most a few rows."""
    failed = results.where(~F.col("passou")).select("tabela", "expectativa", "coluna").take(5)
    if failed:
        raise RuntimeError(f"quality gate {layer} failed: {[tuple(r) for r in failed]}")


def count_consistency(a: Mapping[str, DataFrame], b: Mapping[str, DataFrame], minimum: float = 95.0) -> DataFrame:
    """Row counts of both copies per table; consistent above ``minimum`` per cent."""
    out = []
    for side, tables in (("a", a), ("b", b)):
        for name, df in tables.items():
            counted = df.agg(F.count(F.lit(1)).alias("n"))
            out.append(counted.select(F.lit(name).alias("tabela"), F.lit(side).alias("lado"), "n"))
    sides = reduce(DataFrame.unionByName, out).groupBy("tabela").agg(
        F.sum(F.when(F.col("lado") == "a", F.col("n"))).alias("origem"),
        F.sum(F.when(F.col("lado") == "b", F.col("n"))).alias("destino"),
    )
    difference = F.abs(F.col("origem") - F.col("destino"))
    pct = (1 - difference / F.greatest("origem", F.lit(1))) * 100
    return sides.select(
        "tabela", "origem", "destino", difference.alias("diferenca"), pct.alias("consistencia_pct"),
        F.coalesce(pct > minimum, F.lit(False)).alias("consistente"),
    )
