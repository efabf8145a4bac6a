"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Evaluation days just after the last transaction and the last event.
BANK_DAY = "2001-11-05"
EVENT_DAY = "2024-01-31"

ENTITIES = {
    "clientes": """
        SELECT c_custkey AS id, c_name AS nome,
               CASE WHEN c_acctbal < 0 THEN 'INATIVO' ELSE 'ATIVO' END AS status,
               CAST(floor((c_acctbal + 1000) / 11) AS DOUBLE) AS score_risco,
               DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT) AS data_nascimento,
               DATE '1994-01-01' + CAST(c_custkey % 700 AS INT) AS created_at
        FROM customer""",
    "contas": """
        SELECT o_orderkey AS id, o_custkey AS cliente_id,
               CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'CORRENTE' WHEN '2' THEN 'POUPANCA'
                    WHEN '3' THEN 'SALARIO' ELSE 'INVESTIMENTO' END AS tipo_conta,
               round(o_totalprice) AS saldo, (o_orderkey % 5) * 100000.0e0 AS limite,
               CASE o_orderstatus WHEN 'O' THEN 'ATIVA' WHEN 'P' THEN 'BLOQUEADA' ELSE 'ENCERRADA' END AS status,
               o_orderdate AS data_abertura, o_orderdate AS data_atualizacao
        FROM orders""",
    "transacoes": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS conta_id,
               CASE l_returnflag WHEN 'R' THEN 'PIX' WHEN 'A' THEN 'TED' ELSE 'DOC' END AS tipo_transacao,
               round(l_extendedprice) AS valor, l_shipdate AS data_transacao,
               CASE l_linestatus WHEN 'O' THEN 'AUTORIZADA' ELSE 'PENDENTE' END AS status,
               l_linestatus = 'O' AS aprovada,
               CASE l_suppkey % 3 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'WEB' ELSE 'AGENCIA' END AS canal,
               'C' || CAST(l_suppkey % 20 AS VARCHAR) AS cidade, 'UF' || CAST(l_suppkey % 5 AS VARCHAR) AS estado,
               l_discount AS score_risco, CAST(l_partkey % 500 AS INT) AS tempo_processamento_ms
        FROM lineitem""",
    "eventos": """
        SELECT event_id AS id, user_id AS conta_id,
               CASE event_type WHEN 'purchase' THEN 'PIX' WHEN 'click' THEN 'TED' WHEN 'view' THEN 'DOC'
                    WHEN 'signup' THEN 'CREDITO' ELSE 'DEBITO' END AS tipo_transacao,
               round(value * 100) AS valor, ts AS data_transacao,
               CASE WHEN event_type = 'error' THEN 'REJEITADA' ELSE 'AUTORIZADA' END AS status,
               event_type <> 'error' AS aprovada,
               CASE event_id % 3 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'WEB' ELSE 'AGENCIA' END AS canal,
               'C' || CAST(event_id % 7 AS VARCHAR) AS cidade, 'UF' || CAST(event_id % 5 AS VARCHAR) AS estado,
               CAST(event_id % 100 AS DOUBLE) / 100 AS score_risco, CAST(event_id % 500 AS INT) AS tempo_processamento_ms
        FROM events""",
    "eventos_risco": """
        SELECT id, conta_id, tipo_transacao AS tipo_evento,
               CASE WHEN score_risco >= 0.7e0 THEN 'ALTO' WHEN score_risco >= 0.4e0 THEN 'MEDIO' ELSE 'BAIXO' END AS nivel_risco,
               score_risco, aprovada AS resolvido, data_transacao AS data_evento
        FROM eventos""",
}
NEEDS = {"eventos_risco": ["eventos"]}

FORMATS = {
    "i": "CAST({c} AS BIGINT)",
    "r": "round(CAST({c} AS DOUBLE), 6)",
    "p": "round(CAST({c} AS DOUBLE), 9)",
    "t": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')",
    "d": "strftime(CAST({c} AS DATE), '%Y-%m-%d')",
    "s": "CAST({c} AS VARCHAR)",
    "b": "CAST({c} AS BOOLEAN)",
}


def sql(columns: str, body: str) -> str:
    """SQL over the entities it mentions, with every output column in its portable format.

    ``columns`` is a list of ``name:format``: i whole number, r number to six places,
    p number to nine, t time, d day, s text, b flag.
    """
    wanted = [n for n in ENTITIES if f" {n}" in body or f"({n}" in body]
    for name in list(wanted):
        wanted = [d for d in NEEDS.get(name, []) if d not in wanted] + wanted
    ctes = [f"{n} AS ({ENTITIES[n]})" for n in ENTITIES if n in wanted]
    ctes.append(f"resultado AS ({body})")
    out = ", ".join(
        f"{FORMATS[f].format(c=n)} AS {n}" for n, f in (item.split(":") for item in columns.split())
    )
    return f"WITH {', '.join(ctes)} SELECT {out} FROM resultado"


def portable(df: DataFrame, precise: Sequence[str] = ()) -> DataFrame:
    """Result columns in types every engine shares: whole numbers, rounded numbers, text, flags."""

    def convert(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("byte", "short", "integer", "long"):
            return c.cast("long")
        if kind in ("float", "double", "decimal"):
            return F.round(c.cast("double"), 9 if name in precise else 6)
        if kind in ("timestamp", "timestamp_ntz"):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if kind == "date":
            return F.date_format(c, "yyyy-MM-dd")
        if kind in ("map", "array", "struct"):
            return F.to_json(c)
        return c

    return df.select(*[convert(f.name, f.dataType.typeName()).alias(f.name) for f in df.schema.fields])


def query(name: str, oracle: str | None = None, precise: Sequence[str] = ()):
    """Register a query under a name, with its SQL when there is one."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(configure(spark), sf_dir), precise)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return build

    return register
