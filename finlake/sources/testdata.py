"""Banking entities read from the benchmark tables (customer, orders, lineitem, events).

Each table is read with a declared schema, so scans skip inference, timestamps arrive as
``timestamp`` and filters on plain columns reach the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "c_name AS nome",
        "CASE WHEN c_acctbal < 0 THEN 'INATIVO' ELSE 'ATIVO' END AS status",
        "CAST(floor((c_acctbal + 1000) / 11) AS DOUBLE) AS score_risco",
        "DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT) AS data_nascimento",
        "DATE '1994-01-01' + CAST(c_custkey % 700 AS INT) AS created_at",
    )


def contas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "o_custkey AS cliente_id",
        "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'CORRENTE' WHEN '2' THEN 'POUPANCA' "
        "WHEN '3' THEN 'SALARIO' ELSE 'INVESTIMENTO' END AS tipo_conta",
        "round(o_totalprice) AS saldo",
        "(o_orderkey % 5) * 100000.0D AS limite",
        "CASE o_orderstatus WHEN 'O' THEN 'ATIVA' WHEN 'P' THEN 'BLOQUEADA' ELSE 'ENCERRADA' END AS status",
        "o_orderdate AS data_abertura",
        "o_orderdate AS data_atualizacao",
    )


def transacoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "l_orderkey AS conta_id",
        "CASE l_returnflag WHEN 'R' THEN 'PIX' WHEN 'A' THEN 'TED' ELSE 'DOC' END AS tipo_transacao",
        "round(l_extendedprice) AS valor",
        "l_shipdate AS data_transacao",
        "CASE l_linestatus WHEN 'O' THEN 'AUTORIZADA' ELSE 'PENDENTE' END AS status",
        "l_linestatus = 'O' AS aprovada",
        "CASE l_suppkey % 3 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'WEB' ELSE 'AGENCIA' END AS canal",
        "concat('C', CAST(l_suppkey % 20 AS STRING)) AS cidade",
        "concat('UF', CAST(l_suppkey % 5 AS STRING)) AS estado",
        "l_discount AS score_risco",
        "CAST(l_partkey % 500 AS INT) AS tempo_processamento_ms",
    )


def eventos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        "user_id AS conta_id",
        "CASE event_type WHEN 'purchase' THEN 'PIX' WHEN 'click' THEN 'TED' WHEN 'view' THEN 'DOC' "
        "WHEN 'signup' THEN 'CREDITO' ELSE 'DEBITO' END AS tipo_transacao",
        "round(value * 100) AS valor",
        "ts AS data_transacao",
        "CASE WHEN event_type = 'error' THEN 'REJEITADA' ELSE 'AUTORIZADA' END AS status",
        "event_type <> 'error' AS aprovada",
        "CASE event_id % 3 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'WEB' ELSE 'AGENCIA' END AS canal",
        "concat('C', CAST(event_id % 7 AS STRING)) AS cidade",
        "concat('UF', CAST(event_id % 5 AS STRING)) AS estado",
        "CAST(event_id % 100 AS DOUBLE) / 100 AS score_risco",
        "CAST(event_id % 500 AS INT) AS tempo_processamento_ms",
    )


def eventos_risco(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk events: the event stream with its score banded into a level."""
    return eventos(spark, sf_dir).selectExpr(
        "id",
        "conta_id",
        "tipo_transacao AS tipo_evento",
        "CASE WHEN score_risco >= 0.7 THEN 'ALTO' WHEN score_risco >= 0.4 THEN 'MEDIO' ELSE 'BAIXO' END AS nivel_risco",
        "score_risco",
        "aprovada AS resolvido",
        "data_transacao AS data_evento",
    )
