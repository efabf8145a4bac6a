"""Queries over data quality, personal data, audit, reconciliation and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.personal import PII_COLUMN_NAMES, PII_PATTERNS
from ..operators import audit, checksums, lineage, privacy, quality, reconcile
from ..sources.testdata import clientes, contas, eventos, table, transacoes
from .registry import BANK_DAY, EVENT_DAY, query, sql

# --- quality --------------------------------------------------------------------------------

QUALITY_TABLES = {
    "contas": """SELECT *, lpad(CAST(id % 9000 AS VARCHAR), 6, '0') AS numero_conta,
        CASE WHEN status = 'BLOQUEADA' THEN NULL ELSE 'T' || (cliente_id % 3) END AS tenant_id FROM contas""",
    "clientes": """SELECT id, CASE WHEN status = 'ATIVO' THEN nome END AS nome_completo,
        CASE WHEN id % 5 = 0 THEN 'x' ELSE lpad(CAST(id % 1200 AS VARCHAR), 11, '0') END AS cpf,
        CASE WHEN id % 4 = 0 THEN 'sem email' ELSE 'c' || id || '@banco.com' END AS email, '1199' || lpad(CAST(id AS VARCHAR), 7, '0') AS telefone,
        CASE WHEN id % 2 = 0 THEN 'PF' ELSE 'XX' END AS tipo_pessoa, status, data_nascimento,
        CAST(NULL AS VARCHAR) AS cnpj FROM clientes""",
    "transacoes": """SELECT *, data_transacao + (id % 3 - 1) * INTERVAL 1 DAY AS created_at, 'T1' AS tenant_id FROM transacoes""",
    "pix_pagamentos": """SELECT id, CASE WHEN id % 9 <> 0 THEN 'k' || id END AS chave_pix,
        CASE id % 4 WHEN 0 THEN 'CPF' WHEN 1 THEN 'EMAIL' WHEN 2 THEN 'TELEFONE' ELSE 'PASSAPORTE' END AS tipo_chave_pix,
        valor - 1 AS valor, CASE status WHEN 'REJEITADA' THEN 'FALHOU' ELSE status END AS status,
        'I' || (id % 8) AS ispb_origem, CASE WHEN id % 10 <> 0 THEN 'I1' END AS ispb_destino
        FROM eventos WHERE tipo_transacao = 'PIX'""",
    "credito_solicitacoes": """SELECT id, CASE tipo_conta WHEN 'CORRENTE' THEN 'CONSIGNADO' WHEN 'POUPANCA' THEN 'CARTAO_CREDITO' ELSE tipo_conta END AS tipo_credito,
        saldo / 10 AS valor_solicitado, id % 400 AS prazo_meses, CASE status WHEN 'ATIVA' THEN 'LIBERADO' ELSE 'PERDIDO' END AS status
        FROM contas""",
}


def quality_tables(spark, d):
    key = F.col("id")
    text = key.cast("string")
    return {
        "contas": contas(spark, d).withColumns({
            "numero_conta": F.lpad((key % 9000).cast("string"), 6, "0"),
            "tenant_id": F.when(F.col("status") != "BLOQUEADA", F.concat(F.lit("T"), F.col("cliente_id") % 3)),
        }),
        "clientes": clientes(spark, d).select(
            "id",
            F.when(F.col("status") == "ATIVO", F.col("nome")).alias("nome_completo"),
            F.when(key % 5 == 0, "x").otherwise(F.lpad((key % 1200).cast("string"), 11, "0")).alias("cpf"),
            F.when(key % 4 == 0, "sem email").otherwise(F.concat(F.lit("c"), text, F.lit("@banco.com"))).alias("email"),
            F.concat(F.lit("1199"), F.lpad(text, 7, "0")).alias("telefone"),
            F.when(key % 2 == 0, "PF").otherwise("XX").alias("tipo_pessoa"),
            "status",
            "data_nascimento",
            F.lit(None).cast("string").alias("cnpj"),
        ),
        "transacoes": transacoes(spark, d).withColumns({
            "created_at": F.col("data_transacao") + F.make_dt_interval(days=(key % 3 - 1).cast("int")),
            "tenant_id": F.lit("T1"),
        }),
        "pix_pagamentos": eventos(spark, d).where("tipo_transacao = 'PIX'").select(
            "id",
            F.when(key % 9 != 0, F.concat(F.lit("k"), text)).alias("chave_pix"),
            F.when(key % 4 == 0, "CPF").when(key % 4 == 1, "EMAIL").when(key % 4 == 2, "TELEFONE").otherwise("PASSAPORTE")
            .alias("tipo_chave_pix"),
            (F.col("valor") - 1).alias("valor"),
            F.when(F.col("status") == "REJEITADA", "FALHOU").otherwise(F.col("status")).alias("status"),
            F.concat(F.lit("I"), key % 8).alias("ispb_origem"),
            F.when(key % 10 != 0, "I1").alias("ispb_destino"),
        ),
        "credito_solicitacoes": contas(spark, d).select(
            "id",
            F.when(F.col("tipo_conta") == "CORRENTE", "CONSIGNADO").when(F.col("tipo_conta") == "POUPANCA", "CARTAO_CREDITO")
            .otherwise(F.col("tipo_conta")).alias("tipo_credito"),
            (F.col("saldo") / 10).alias("valor_solicitado"),
            (key % 400).alias("prazo_meses"),
            F.when(F.col("status") == "ATIVA", "LIBERADO").otherwise("PERDIDO").alias("status"),
        ),
    }


def _check_sql(name: str, i: int, e: quality.Expectation) -> str:
    column, low, high = e.column, e.args.get("min_value"), e.args.get("max_value")
    if e.kind == quality.NOT_NULL:
        failures = f"SELECT count(*) FROM q_{name} WHERE {column} IS NULL"
    elif e.kind == quality.UNIQUE:
        failures = f"SELECT count(*) FROM (SELECT {column} FROM q_{name} GROUP BY 1 HAVING count(*) > 1)"
    elif e.kind == quality.IN_SET:
        allowed = ", ".join(f"'{v}'" for v in e.args["value_set"])
        failures = f"SELECT count(DISTINCT {column}) FROM q_{name} WHERE {column} NOT IN ({allowed})"
    elif e.kind == quality.REGEX:
        failures = f"SELECT count(*) FROM q_{name} WHERE NOT regexp_matches({column}, '{e.args['regex']}')"
    elif e.kind == quality.BETWEEN:
        failures = f"SELECT count(*) FROM q_{name} WHERE {column} < {low} OR {column} > {high}"
    elif e.kind == quality.ROW_COUNT:
        failures = f"SELECT CASE WHEN count(*) BETWEEN {low} AND {high} THEN 0 ELSE 1 END FROM q_{name}"
    elif e.kind == quality.LENGTH:
        failures = f"SELECT count(*) FROM q_{name} WHERE NOT length({column}) BETWEEN {low} AND {high}"
    else:
        failures = f"SELECT count(*) FROM q_{name} WHERE NOT ({e.args['column_A']} > {e.args['column_B']})"
    label = column or "/".join(e.columns())
    shown = f"'{label}'" if label else "NULL"
    return (
        f"SELECT '{name}' AS tabela, {i} AS posicao, '{e.kind}' AS expectativa, {shown} AS coluna, ({failures}) AS falhas, "
        f"(SELECT count(*) FROM q_{name}) AS total_linhas"
    )


def _quality_sql() -> str:
    ctes = ", ".join(f"q_{n} AS ({body})" for n, body in QUALITY_TABLES.items())
    checks = " UNION ALL ".join(
        _check_sql(n, i, e) for n in QUALITY_TABLES for i, e in enumerate(quality.SUITES[n])
    )
    return f"WITH {ctes} {checks}"


QUALITY_COLUMNS = "tabela:s posicao:i expectativa:s coluna:s passou:b falhas:i total_linhas:i"


@query("dq_report", sql(QUALITY_COLUMNS, f"SELECT *, falhas = 0 AS passou FROM ({_quality_sql()})"))
def dq_report(spark, d):
    results, _ = quality.run_all(spark, quality_tables(spark, d), samples=False)
    return results.select("tabela", "posicao", "expectativa", "coluna", "passou", "falhas", "total_linhas")


@query("dq_samples", sql(
    "tabela:s coluna:s amostra:s", f"""
    WITH q AS ({QUALITY_TABLES['clientes']}), c AS ({QUALITY_TABLES['contas']}),
    v AS (SELECT 'clientes' AS tabela, 'cpf' AS coluna, cpf AS v, 5 AS n FROM q GROUP BY cpf HAVING count(*) > 1
          UNION ALL SELECT DISTINCT 'clientes', 'tipo_pessoa', tipo_pessoa, 10 FROM q WHERE tipo_pessoa NOT IN ('PF', 'PJ')
          UNION ALL SELECT 'contas', 'numero_conta', numero_conta, 5 FROM c GROUP BY numero_conta HAVING count(*) > 1)
    SELECT tabela, coluna, '["' || string_agg(v, '","' ORDER BY v) || '"]' AS amostra
    FROM (SELECT *, row_number() OVER (PARTITION BY tabela, coluna ORDER BY v) AS rn FROM v) WHERE rn <= n
    GROUP BY tabela, coluna"""))
def _(spark, d):
    results, _ = quality.run_all(spark, quality_tables(spark, d), ["clientes", "contas"])
    return results.where(F.size("amostra") > 0).select("tabela", "coluna", "amostra")


@query("dq_summary", sql(
    "total_checks:i total_passed:i total_failed:i pass_rate:r", f"""
    SELECT count(*) AS total_checks, count(*) FILTER (falhas = 0) AS total_passed, count(*) FILTER (falhas > 0) AS total_failed,
           count(*) FILTER (falhas = 0) * 100.0e0 / count(*) AS pass_rate FROM ({_quality_sql()})"""))
def _(spark, d):
    return quality.quality_report(dq_report(spark, d))


@query("dq_dirty", sql(
    "posicao:i passou:b falhas:i com_erro:b", """
    SELECT 0 AS posicao, false AS passou, count(*) FILTER (id % 7 = 0 OR valor > 1000) AS falhas, false AS com_erro FROM eventos
    UNION ALL SELECT 1, false, 0, true
    UNION ALL SELECT 2, true, 0, false FROM (SELECT 1) WHERE (SELECT count(*) FROM eventos) > 0"""))
def _(spark, d):
    """Text among the numbers, and a comparison of types that cannot be compared."""
    rows = eventos(spark, d)
    dirty = rows.select("id", F.when(F.col("id") % 7 == 0, "abc").otherwise(F.col("valor").cast("string")).alias("valor"), F.array("id").alias("lista"))
    suite = [quality.between("valor", 0, 1000), quality.pair_greater("lista", "valor"), quality.not_null("id")]
    found = quality.run_suite(dirty, "sujos", suite)
    return found.select("posicao", "passou", "falhas", F.col("erro").isNotNull().alias("com_erro"))


@query("dq_unique", sql(
    "tabela:s coluna:s falhas:i", """
    SELECT 'transacoes' AS tabela, 'id' AS coluna,
           (SELECT count(*) FROM (SELECT id FROM transacoes GROUP BY id HAVING count(*) > 1)) AS falhas"""))
def _(spark, d):
    checked = quality.run_suite(transacoes(spark, d), "transacoes", [quality.unique("id")])
    return checked.select("tabela", "coluna", "falhas")


@query("count_consistency", sql(
    "tabela:s origem:i destino:i diferenca:i consistencia_pct:r consistente:b", """
    SELECT tabela, origem, destino, abs(origem - destino) AS diferenca,
           (1 - abs(origem - destino) * 1.0e0 / greatest(origem, 1)) * 100 AS consistencia_pct,
           (1 - abs(origem - destino) * 1.0e0 / greatest(origem, 1)) * 100 > 95 AS consistente
    FROM (SELECT 'contas' AS tabela, count(*) AS origem, count(*) FILTER (status <> 'BLOQUEADA') AS destino FROM contas
          UNION ALL SELECT 'clientes', count(*), count(*) FILTER (score_risco > 20) FROM clientes)"""))
def _(spark, d):
    a = {"contas": contas(spark, d), "clientes": clientes(spark, d)}
    b = {
        "contas": a["contas"].where(F.col("status") != "BLOQUEADA"),
        "clientes": a["clientes"].where(F.col("score_risco") > 20),
    }
    return quality.count_consistency(a, b)


# --- personal data --------------------------------------------------------------------------

ANY_PII = "|".join(f"(?:{p})" for p in PII_PATTERNS.values())


@query("classify_rows", sql(
    "doc_id:i campos_pii:i classificacao:s", f"""
    SELECT doc_id, n AS campos_pii, CASE WHEN n >= 3 THEN 'restricted' WHEN n = 2 THEN 'confidential'
           WHEN n = 1 THEN 'internal' ELSE 'public' END AS classificacao
    FROM (SELECT doc_id, CAST(regexp_matches(text, '{ANY_PII}') AS INT) + CAST(regexp_matches(source, '{ANY_PII}') AS INT) AS n
          FROM documents)"""))
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return privacy.classify_rows(docs).select("doc_id", "campos_pii", "classificacao")


@query("pii_matches", sql(
    "doc_id:i " + " ".join(f"qtd_{k}:i" for k in PII_PATTERNS),
    "SELECT doc_id, "
    + ", ".join(f"len(regexp_extract_all(text, '{p}')) AS qtd_{k}" for k, p in PII_PATTERNS.items())
    + " FROM documents"))
def _(spark, d):
    return privacy.pii_matches(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"])


@query("pii_columns", sql(
    "coluna:s linhas_pii:i linhas:i classificacao:s", f"""
    SELECT coluna, n AS linhas_pii, t AS linhas, CASE WHEN n > 0 THEN 'PII' ELSE 'NORMAL' END AS classificacao
    FROM (SELECT 'text' AS coluna, count(*) FILTER (regexp_matches(text, '{ANY_PII}')) AS n, count(*) AS t FROM documents
          UNION ALL SELECT 'lang', count(*) FILTER (regexp_matches(lang, '{ANY_PII}')), count(*) FROM documents
          UNION ALL SELECT 'source', count(*) FILTER (regexp_matches(source, '{ANY_PII}')), count(*) FROM documents)"""))
def _(spark, d):
    return privacy.pii_columns(table(spark, d, "documents"))


PEOPLE = """
    SELECT id, nome AS name, lpad(CAST(id AS VARCHAR), 11, '0') AS cpf,
           CASE WHEN status = 'ATIVO' THEN 'cliente' || id || '@banco.com' ELSE 'sem endereco' END AS email,
           '11' || lpad(CAST(id AS VARCHAR), 9, '9') AS phone, 'Rua ' || id AS address FROM clientes"""


def _people(spark, d):
    key = F.col("id").cast("string")
    return clientes(spark, d).select(
        "id",
        F.col("nome").alias("name"),
        F.lpad(key, 11, "0").alias("cpf"),
        F.when(F.col("status") == "ATIVO", F.concat(F.lit("cliente"), key, F.lit("@banco.com")))
        .otherwise("sem endereco").alias("email"),
        F.concat(F.lit("11"), F.lpad(key, 9, "9")).alias("phone"),
        F.concat(F.lit("Rua "), key).alias("address"),
    )


@query("anonymize", sql(
    "id:i name:s cpf:s email:s phone:s address:s", f"""
    SELECT id, left(name, 1) || '***' AS name, '***.***.***-' || right(cpf, 2) AS cpf,
           CASE WHEN contains(email, '@') THEN left(split_part(email, '@', 1), 2) || '***@' || split_part(email, '@', 2)
                ELSE left(sha256(email), 8) END AS email,
           '(' || left(phone, 2) || ') ***-' || right(phone, 4) AS phone, left(sha256(address), 8) AS address
    FROM ({PEOPLE})"""))
def _(spark, d):
    return privacy.anonymize(_people(spark, d), ["name", "cpf", "email", "phone", "address", "unknown"])


# One row per account: the same person appears once per account, the newest one counts.
HOLDERS = """
    SELECT c.id AS cliente_id, c.nome AS name, o.data_abertura, o.id AS conta,
           '123.456.' || lpad(CAST(c.id % 1000 AS VARCHAR), 3, '0') || '-00' AS cpf,
           CASE WHEN c.status = 'ATIVO' THEN 'cliente' || c.id || '@banco.com' ELSE 'c' || c.id END AS email,
           CASE WHEN o.status = 'ATIVA' THEN '(11) 91234-5678' ELSE '-' END AS phone, o.tipo_conta AS address,
           o.status = 'ATIVA' AS consent_given
    FROM contas o JOIN clientes c ON c.id = o.cliente_id"""


def _holders(spark, d):
    people = clientes(spark, d).select(F.col("id").alias("cliente_id"), F.col("nome").alias("name"), F.col("status").alias("st"))
    key = F.col("cliente_id")
    return contas(spark, d).join(people, "cliente_id").select(
        "name",
        F.concat(F.lit("123.456."), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit("-00")).alias("cpf"),
        F.when(F.col("st") == "ATIVO", F.concat(F.lit("cliente"), key, F.lit("@banco.com")))
        .otherwise(F.concat(F.lit("c"), key)).alias("email"),
        F.when(F.col("status") == "ATIVA", "(11) 91234-5678").otherwise("-").alias("phone"),
        F.col("tipo_conta").alias("address"),
        (F.col("status") == "ATIVA").alias("consent_given"),
        "data_abertura",
        F.col("id").alias("conta"),
    )


def _subjects(spark, d):
    return privacy.data_subjects(_holders(spark, d), ["data_abertura", "conta"], BANK_DAY)


SUBJECTS = f"""
    SELECT sha256(cpf || email) AS id, name, email, cpf, phone, address,
           CASE WHEN n >= 3 THEN 'restricted' WHEN n = 2 THEN 'confidential' WHEN n = 1 THEN 'internal' ELSE 'public' END AS data_classification,
           consent_given, TIMESTAMP '{BANK_DAY}' AS consent_date,
           CASE WHEN n >= 3 THEN 2555 WHEN n = 2 THEN 365 ELSE 30 END AS data_retention
    FROM (SELECT *, 1 + CAST(contains(email, '@') AS INT) + CAST(phone <> '-' AS INT) AS n FROM ({HOLDERS}))
    QUALIFY row_number() OVER (PARTITION BY cpf, email ORDER BY data_abertura DESC, conta DESC) = 1"""


@query("data_subjects", sql(
    "id:s name:s email:s cpf:s phone:s address:s data_classification:s consent_given:b consent_date:t data_retention:i",
    SUBJECTS))
def _(spark, d):
    return _subjects(spark, d)


PURPOSES = """
    SELECT sha256(cpf || email) AS data_subject_id, 'analise ' || address AS processing_purpose,
           CASE WHEN consent_given THEN 'consent' ELSE 'contract' END AS legal_basis, data_abertura AS processing_date,
           'finlake' AS processor FROM ({holders})
    UNION ALL SELECT sha256('desconhecido' || id), 'analise', 'consent', data_abertura, 'finlake'
              FROM contas WHERE status = 'BLOQUEADA'""".replace("{holders}", HOLDERS)


def _purposes(spark, d):
    known = _holders(spark, d).select(
        F.sha2(F.concat("cpf", "email"), 256).alias("data_subject_id"),
        F.concat(F.lit("analise "), "address").alias("processing_purpose"),
        F.when(F.col("consent_given"), "consent").otherwise("contract").alias("legal_basis"),
        F.when(F.col("consent_given"), F.array(F.lit("financeiro"), F.lit("contato"))).otherwise(F.array(F.lit("financeiro")))
        .alias("data_categories"),
        F.col("data_abertura").alias("processing_date"),
        F.lit("finlake").alias("processor"),
    )
    unknown = contas(spark, d).where(F.col("status") == "BLOQUEADA").select(
        F.sha2(F.concat(F.lit("desconhecido"), F.col("id").cast("string")), 256).alias("data_subject_id"),
        F.lit("analise").alias("processing_purpose"),
        F.lit("consent").alias("legal_basis"),
        F.array(F.lit("contato")).alias("data_categories"),
        F.col("data_abertura").alias("processing_date"),
        F.lit("finlake").alias("processor"),
    )
    return known.unionByName(unknown)


RECORDS = f"""
    SELECT sha256(p.data_subject_id || p.processing_purpose || strftime(p.processing_date, '%Y-%m-%d %H:%M:%S.%f')) AS id,
           p.*, s.data_retention AS retention_period, s.data_classification IN ('confidential', 'restricted') AS anonymization_required
    FROM ({PURPOSES}) p JOIN ({SUBJECTS}) s ON s.id = p.data_subject_id"""


@query("processing_records", sql(
    "id:s data_subject_id:s processing_purpose:s legal_basis:s processing_date:t processor:s retention_period:i "
    "anonymization_required:b", RECORDS))
def _(spark, d):
    return privacy.processing_records(_purposes(spark, d), _subjects(spark, d))[0].drop("data_categories")


@query("rejected_records", sql(
    "data_subject_id:s processing_purpose:s legal_basis:s processing_date:t processor:s",
    f"SELECT * FROM ({PURPOSES}) WHERE processing_purpose = 'analise'"))
def _(spark, d):
    return privacy.processing_records(_purposes(spark, d), _subjects(spark, d))[1].drop("data_categories")


EXPIRED = f"""
    SELECT id AS record_id, data_subject_id, processing_purpose, processing_date + to_days(retention_period) AS expiration_date,
           date_sub('day', processing_date + to_days(retention_period), TIMESTAMP '{BANK_DAY}') AS days_overdue
    FROM ({RECORDS}) WHERE TIMESTAMP '{BANK_DAY}' > processing_date + to_days(retention_period)"""


def _records(spark, d):
    return privacy.processing_records(_purposes(spark, d), _subjects(spark, d))[0]


@query("expired_records", sql(
    "record_id:s data_subject_id:s processing_purpose:s expiration_date:t days_overdue:i", EXPIRED))
def _(spark, d):
    return privacy.expired_records(_records(spark, d), BANK_DAY)


@query("inventory", sql(
    "metrica:s chave:s total:i", f"""
    WITH s AS ({SUBJECTS}), r AS ({RECORDS})
    SELECT 'total_data_subjects' AS metrica, NULL AS chave, count(*) AS total FROM s
    UNION ALL SELECT 'classification_distribution', data_classification, count(*) FROM s GROUP BY 2
    UNION ALL SELECT 'retention_distribution', CAST(data_retention AS VARCHAR), count(*) FROM s GROUP BY 2
    UNION ALL SELECT 'total_processing_records', NULL, count(*) FROM r
    UNION ALL SELECT 'legal_basis_distribution', legal_basis, count(*) FROM r GROUP BY 2
    UNION ALL SELECT 'processing_purposes', processing_purpose, count(*) FROM r GROUP BY 2
    UNION ALL SELECT 'data_categories', 'financeiro', count(*) FROM r
    UNION ALL SELECT 'data_categories', 'contato', count(*) FROM r WHERE legal_basis = 'consent'"""))
def _(spark, d):
    return privacy.data_inventory(_subjects(spark, d), _records(spark, d))


@query("compliance_report", sql(
    "compliance_status:s total_data_subjects:i total_processing_records:i expired_data_count:i recommendations:s", f"""
    WITH s AS ({SUBJECTS}), r AS ({RECORDS}), e AS ({EXPIRED}),
    c AS (SELECT (SELECT count(*) FROM s) AS s, (SELECT count(*) FROM r) AS r, (SELECT count(*) FROM e) AS e,
                 (SELECT count(*) FROM s WHERE data_classification = 'restricted') AS res,
                 (SELECT count(*) FROM r WHERE legal_basis = 'consent') AS con)
    SELECT CASE WHEN e = 0 THEN 'COMPLIANT' ELSE 'NON_COMPLIANT' END AS compliance_status, s AS total_data_subjects,
           r AS total_processing_records, e AS expired_data_count,
           '[' || concat_ws(',', CASE WHEN e > 0 THEN '"Remover ' || e || ' registros de dados expirados"' END,
               CASE WHEN res > 100 THEN '"Considerar anonimização de dados restritos"' END,
               CASE WHEN con < r * 0.5 THEN '"Aumentar uso de consentimento explícito"' END) || ']' AS recommendations
    FROM c"""))
def _(spark, d):
    return privacy.compliance_report(_subjects(spark, d), _records(spark, d), BANK_DAY)


def _catalogue(spark, d):
    """Every word of the documents as a column name of its source."""
    return table(spark, d, "documents").select(
        F.col("source").alias("table_name"), F.explode(F.split("text", " ")).alias("column_name")
    )


PERSONAL = " OR ".join(f"contains(lower(column_name), '{p}')" for p in PII_COLUMN_NAMES)
WORDS = "SELECT source AS table_name, unnest(string_split(text, ' ')) AS column_name FROM documents"


@query("classify_columns", sql(
    "table_name:s classification:s n:i", f"""
    SELECT table_name, CASE WHEN {PERSONAL} THEN 'PII' ELSE 'NORMAL' END AS classification, count(*) AS n
    FROM ({WORDS}) GROUP BY ALL"""))
def _(spark, d):
    named = privacy.classify_columns(_catalogue(spark, d))
    return named.groupBy("table_name", "classification").agg(F.count(F.lit(1)).alias("n"))


@query("classify_datasets", sql(
    "table_name:s total_columns:i pii_columns:i classification:s", f"""
    SELECT table_name, count(*) AS total_columns, count(*) FILTER ({PERSONAL}) AS pii_columns,
           CASE WHEN bool_or({PERSONAL}) THEN 'PII' ELSE 'NORMAL' END AS classification
    FROM ({WORDS}) GROUP BY table_name"""))
def _(spark, d):
    return privacy.classify_datasets(_catalogue(spark, d))


# --- audit ----------------------------------------------------------------------------------

CHANGED_LAKE = """
    SELECT id, cliente_id, CASE WHEN status = 'BLOQUEADA' THEN saldo + 1 ELSE saldo END AS saldo,
           CASE WHEN tipo_conta = 'SALARIO' THEN NULL ELSE status END AS status, data_atualizacao
    FROM contas WHERE saldo < 400000"""


def _lake_accounts(spark, d):
    """The accounts as a second system has them: some changed, some missing."""
    return contas(spark, d).where(F.col("saldo") < 400000).select(
        "id",
        "cliente_id",
        F.when(F.col("status") == "BLOQUEADA", F.col("saldo") + 1).otherwise(F.col("saldo")).alias("saldo"),
        F.when(F.col("tipo_conta") != "SALARIO", F.col("status")).alias("status"),
        "data_atualizacao",
    )


@query("audit_diff", sql(
    "id:i acao:s campo:s old_value:s new_value:s", f"""
    WITH o AS (SELECT id, saldo, status FROM contas), n AS (SELECT id, saldo, status FROM ({CHANGED_LAKE})),
    j AS (SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN 'DELETE' WHEN o.id IS NULL THEN 'INSERT' ELSE 'MODIFY' END AS acao,
                 CAST(CAST(o.saldo AS BIGINT) AS VARCHAR) AS os, CAST(CAST(n.saldo AS BIGINT) AS VARCHAR) AS ns, o.status AS ot, n.status AS nt
          FROM o FULL JOIN n ON n.id = o.id)
    SELECT id, acao, 'saldo' AS campo, os AS old_value, ns AS new_value FROM j WHERE os IS DISTINCT FROM ns
    UNION ALL SELECT id, acao, 'status', ot, nt FROM j WHERE ot IS DISTINCT FROM nt"""))
def _(spark, d):
    def side(df):
        return df.select("id", F.col("saldo").cast("long").alias("saldo"), "status")

    changes = audit.changed_fields(side(contas(spark, d)), side(_lake_accounts(spark, d)), ["id"])
    return audit.long_changes(changes, ["id"])


@query("audit_modifications", sql(
    "user_id:s table_name:s operation:s n:i", f"""
    SELECT 'auditor' AS user_id, 'contas' AS table_name, 'MODIFY' AS operation, count(*) AS n
    FROM contas o FULL JOIN ({CHANGED_LAKE}) n ON n.id = o.id
    WHERE o.saldo IS DISTINCT FROM n.saldo OR o.status IS DISTINCT FROM n.status"""))
def _(spark, d):
    old = contas(spark, d).select("id", "saldo", "status")
    new = _lake_accounts(spark, d).select("id", "saldo", "status")
    log = audit.audit_modifications(old, new, ["id"], "contas", "auditor", BANK_DAY)
    return log.groupBy("user_id", "table_name", "operation").agg(F.countDistinct("id").alias("n"))


STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


@query("audit_access", sql(
    "id:s user_id:s table_name:s operation:s filters:s timestamp:t", f"""
    SELECT sha256(CAST(user_id AS VARCHAR) || 'contas' || 'SELECT' || {STAMP.format("ts")}) AS id, CAST(user_id AS VARCHAR) AS user_id,
           'contas' AS table_name, 'SELECT' AS operation, '{{"tipo":"' || event_type || '"}}' AS filters, ts AS timestamp FROM events"""))
def _(spark, d):
    accesses = table(spark, d, "events").select(
        "user_id", F.col("ts").alias("timestamp"), F.create_map(F.lit("tipo"), "event_type").alias("filters")
    )
    return audit.audit_access(accesses, "contas").select("id", "user_id", "table_name", "operation", "filters", "timestamp")


@query("audit_deletions", sql(
    "id:s user_id:s table_name:s operation:s saldo:s status:s n:i", f"""
    SELECT sha256('auditor' || 'contas' || 'delete' || '{BANK_DAY} 00:00:00.000000' || CAST(id AS VARCHAR)) AS id, 'auditor' AS user_id,
           'contas' AS table_name, 'DELETE' AS operation, CAST(CAST(saldo AS BIGINT) AS VARCHAR) AS saldo, status, 3 AS n
    FROM contas WHERE saldo >= 400000"""))
def _(spark, d):
    gone = contas(spark, d).where(F.col("saldo") >= 400000).select("id", F.col("saldo").cast("long").alias("saldo"), "status")
    log = audit.audit_deletions(gone, ["id"], "contas", "auditor", BANK_DAY)
    image = F.col("deleted_data")
    return log.select("id", "user_id", "table_name", "operation", image["saldo"].alias("saldo"), image["status"].alias("status"), F.size(image).alias("n"))


def _access_log(spark, d):
    return table(spark, d, "events").select(
        "user_id", F.col("event_type").alias("operation"), F.concat(F.lit("t"), F.col("user_id") % 4).alias("table_name"),
        F.col("ts").alias("timestamp"), F.col("props").alias("changes"),
    )


LOG = "SELECT user_id, event_type AS operation, 't' || (user_id % 4) AS table_name, ts AS timestamp, props AS changes, event_id FROM events"


@query("audit_report", sql(
    "dimensao:s chave:s total:i", f"""
    WITH l AS (SELECT * FROM ({LOG}) WHERE timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25')
    SELECT 'total_operations' AS dimensao, NULL AS chave, count(*) AS total FROM l
    UNION ALL SELECT 'operation', operation, count(*) FROM l GROUP BY 2
    UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM l GROUP BY 2
    UNION ALL SELECT 'table_name', table_name, count(*) FROM l GROUP BY 2"""))
def _(spark, d):
    return audit.audit_report(_access_log(spark, d), "2024-01-05", "2024-01-25")


@query("audit_log_period", sql(
    "user_id:i operation:s timestamp:t",
    f"SELECT * FROM ({LOG}) WHERE timestamp BETWEEN TIMESTAMP '{EVENT_DAY}' - INTERVAL 30 DAY AND TIMESTAMP '{EVENT_DAY}'"))
def _(spark, d):
    return audit.in_period(_access_log(spark, d), end=EVENT_DAY).select("user_id", "operation", "timestamp")


@query("record_lineage", sql(
    "user_id:i operation:s timestamp:t changes:s",
    f"SELECT * FROM ({LOG}) WHERE table_name = 't1' AND contains(changes, '69')"))
def _(spark, d):
    return audit.record_lineage(_access_log(spark, d), "t1", "69").select("user_id", "operation", "timestamp", "changes")


# --- reconciliation -------------------------------------------------------------------------

PCT = """CASE WHEN {a} = 0 AND {b} = 0 THEN 0.0e0 WHEN {a} = 0 THEN 100.0e0 ELSE abs({a} - {b}) * 1.0e0 / abs({a}) * 100 END"""


def _pct(a: str, b: str) -> str:
    return PCT.replace("{a}", a).replace("{b}", b)


def _both(spark, d):
    core = {"contas": contas(spark, d), "clientes": clientes(spark, d), "transacoes": transacoes(spark, d)}
    lake = {
        "contas": _lake_accounts(spark, d),
        "clientes": core["clientes"],
        "transacoes": core["transacoes"].where(F.col("valor") > 1000),
    }
    return core, lake


TOTALS = f"""
    SELECT *, diverg AS divergencia_pct_max, diverg > 0.01 AS diverge FROM (
        SELECT *, greatest({_pct('core_total', 'lake_total')}, CASE WHEN core_valor IS NOT NULL THEN {_pct('core_valor', 'lake_valor')} END) AS diverg
        FROM (SELECT 'contas' AS tabela, (SELECT count(*) FROM contas) AS core_total, (SELECT count(*) FROM ({CHANGED_LAKE})) AS lake_total,
                     (SELECT sum(saldo) FROM contas) AS core_valor, (SELECT sum(saldo) FROM ({CHANGED_LAKE})) AS lake_valor
              UNION ALL SELECT 'clientes', (SELECT count(*) FROM clientes), (SELECT count(*) FROM clientes), NULL, NULL
              UNION ALL SELECT 'transacoes', (SELECT count(*) FROM transacoes), (SELECT count(*) FROM transacoes WHERE valor > 1000),
                     (SELECT sum(valor) FROM transacoes), (SELECT sum(valor) FROM transacoes WHERE valor > 1000)))"""


@query("reconcile_totals", sql(
    "tabela:s core_total:i lake_total:i core_valor:r lake_valor:r divergencia_pct_max:r diverge:b", TOTALS))
def _(spark, d):
    return reconcile.reconcile_totals(*_both(spark, d)).drop("erro")


DAILY = f"""
    SELECT dia, core_n, lake_n, core_valor, lake_valor, {_pct('core_n', 'lake_n')} AS divergencia_pct,
           {_pct('core_n', 'lake_n')} > 0.01 AS diverge
    FROM (SELECT coalesce(c.dia, l.dia) AS dia, coalesce(c.n, 0) AS core_n, coalesce(l.n, 0) AS lake_n,
                 coalesce(c.v, 0) AS core_valor, coalesce(l.v, 0) AS lake_valor
          FROM (SELECT CAST(data_atualizacao AS DATE) AS dia, count(*) AS n, sum(saldo) AS v FROM contas
                WHERE data_atualizacao >= TIMESTAMP '2001-08-02' - INTERVAL 3650 DAY GROUP BY 1) c
          FULL JOIN (SELECT CAST(data_atualizacao AS DATE) AS dia, count(*) AS n, sum(saldo) AS v FROM ({CHANGED_LAKE})
                WHERE data_atualizacao >= TIMESTAMP '2001-08-02' - INTERVAL 3650 DAY GROUP BY 1) l ON l.dia = c.dia)"""


def _daily(spark, d):
    return reconcile.reconcile_daily(
        contas(spark, d), _lake_accounts(spark, d), days=3650, as_of="2001-08-02", value="saldo"
    )


@query("reconcile_daily", sql(
    "dia:d core_n:i lake_n:i core_valor:r lake_valor:r divergencia_pct:r diverge:b", DAILY))
def _(spark, d):
    return _daily(spark, d)


EXTERNAL = f"""
    SELECT *, greatest({_pct('spi_n', 'lake_n')}, {_pct('spi_valor', 'lake_valor')}) AS divergencia_pct,
           greatest({_pct('spi_n', 'lake_n')}, {_pct('spi_valor', 'lake_valor')}) > 0.01 AS diverge
    FROM (SELECT count(*) AS spi_n, sum(valor) AS spi_valor, count(*) FILTER (status = 'AUTORIZADA') AS lake_n,
                 sum(valor) FILTER (status = 'AUTORIZADA') AS lake_valor FROM eventos WHERE tipo_transacao IN ('PIX', 'DEBITO'))"""


def _external(spark, d):
    settled = eventos(spark, d).where(F.col("tipo_transacao").isin("PIX", "DEBITO"))
    consolidated = settled.groupBy("canal").agg(F.count(F.lit(1)).alias("quantidade"), F.sum("valor").alias("valor"))
    return reconcile.reconcile_external(consolidated, settled.where(F.col("status") == "AUTORIZADA"))


@query("reconcile_external", sql(
    "spi_n:i spi_valor:r lake_n:i lake_valor:r divergencia_pct:r diverge:b", EXTERNAL))
def _(spark, d):
    return _external(spark, d)


@query("divergence_metrics", sql(
    "escopo:s divergencias:i divergencia_pct:r ok:r", f"""
    WITH r AS (SELECT 'saldos' AS escopo, diverge, divergencia_pct_max AS pct FROM ({TOTALS})
               UNION ALL SELECT 'transacoes', diverge, divergencia_pct FROM ({DAILY})
               UNION ALL SELECT 'pix', diverge, divergencia_pct FROM ({EXTERNAL}))
    SELECT coalesce(escopo, 'global') AS escopo, count(*) FILTER (diverge) AS divergencias,
           CASE WHEN count(*) FILTER (diverge) > 0 THEN greatest(max(pct), 100) ELSE max(pct) END AS divergencia_pct,
           CASE WHEN count(*) FILTER (diverge) = 0 THEN 1 ELSE 0 END AS ok
    FROM r GROUP BY ROLLUP (escopo)"""))
def _(spark, d):
    totals = reconcile.reconcile_totals(*_both(spark, d))
    return reconcile.divergence_metrics({"saldos": totals, "transacoes": _daily(spark, d), "pix": _external(spark, d)})


# --- lineage --------------------------------------------------------------------------------

NAMES = ["data", "model", "test", "licen", "http", "water"]


@query("view_dependencies", sql(
    "origem:s destino:i", " UNION ALL ".join(
        f"SELECT '{n}' AS origem, doc_id AS destino FROM documents WHERE contains(lower(text), '{n}')" for n in NAMES)))
def _(spark, d):
    return lineage.view_dependencies(table(spark, d, "documents"), NAMES, "doc_id", "text")


def _jobs(spark, d):
    """Each event as a job that reads two account tables and writes one metric table."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("job"),
        F.array(F.concat(F.lit("conta"), F.col("user_id")), F.lit("clientes")).alias("inputs"),
        F.array(F.concat(F.lit("metrica_"), F.col("event_type"))).alias("outputs"),
    )


EDGES = """
    SELECT event_type AS job, o AS origem, 'metrica_' || event_type AS destino
    FROM (SELECT event_type, unnest(['conta' || user_id, 'clientes']) AS o FROM events)"""


@query("job_edges", sql("job:s origem:s destino:s n:i", f"SELECT *, count(*) AS n FROM ({EDGES}) GROUP BY ALL"))
def _(spark, d):
    edges = lineage.job_edges(_jobs(spark, d))
    return edges.groupBy("job", "origem", "destino").agg(F.count(F.lit(1)).alias("n"))


@query("pipeline_summary", sql(
    "total_sources:i total_transformations:i total_sinks:i", f"""
    SELECT count(DISTINCT origem) AS total_sources, count(DISTINCT job) AS total_transformations,
           count(DISTINCT destino) AS total_sinks FROM ({EDGES})"""))
def _(spark, d):
    return lineage.pipeline_summary(lineage.job_edges(_jobs(spark, d)))


@query("view_edges", sql(
    "origem:s destino:i", """
    WITH w AS (SELECT string_split(lower(text), ' ') AS w FROM documents),
    n AS (
        SELECT DISTINCT name FROM (
            SELECT w[1] AS name FROM w UNION ALL SELECT w[1] || ' ' || w[2] FROM w
            UNION ALL SELECT event_type FROM events)
        WHERE trim(name, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '')
    SELECT name AS origem, doc_id AS destino FROM documents JOIN n ON contains(lower(text), name)"""))
def _(spark, d):
    words = F.split(F.lower(F.col("text")), " ")
    first, second = words[0], F.get(words, F.lit(1))
    names = table(spark, d, "documents").select(F.explode(F.array(first, F.concat(first, F.lit(" "), second))).alias("table_name"))
    names = names.unionByName(table(spark, d, "events").select(F.col("event_type").alias("table_name")))
    return lineage.view_edges(table(spark, d, "documents"), names.distinct(), "doc_id", "text")


@query("records_lineage", sql(
    "record_id:s event_id:i", f"""
    SELECT c_custkey AS record_id, event_id FROM customer JOIN ({LOG}) ON contains(changes, CAST(c_custkey AS VARCHAR))
    WHERE table_name = 't1'"""))
def _(spark, d):
    log = table(spark, d, "events").select(
        F.concat(F.lit("t"), F.col("user_id") % 4).alias("table_name"), F.col("props").alias("changes"), "event_id"
    )
    records = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("record_id"))
    return audit.records_lineage(log, records, "t1", key="event_id")


@query("audit_diff_ranges", sql(
    "id:i acao:s campo:s old_value:s new_value:s", f"""
    WITH o AS (SELECT id, saldo, status FROM contas), n AS (SELECT id, saldo, status FROM ({CHANGED_LAKE})),
    j AS (SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN 'DELETE' WHEN o.id IS NULL THEN 'INSERT' ELSE 'MODIFY' END AS acao,
                 CAST(CAST(o.saldo AS BIGINT) AS VARCHAR) AS os, CAST(CAST(n.saldo AS BIGINT) AS VARCHAR) AS ns, o.status AS ot, n.status AS nt
          FROM o FULL JOIN n ON n.id = o.id)
    SELECT id, acao, 'saldo' AS campo, os AS old_value, ns AS new_value FROM j WHERE os IS DISTINCT FROM ns
    UNION ALL SELECT id, acao, 'status', ot, nt FROM j WHERE ot IS DISTINCT FROM nt"""))
def _(spark, d):
    def side(df):
        return df.select("id", F.col("saldo").cast("long").alias("saldo"), "status")

    changes = checksums.changed_by_ranges(side(contas(spark, d)), side(_lake_accounts(spark, d)), ["id"])
    return audit.long_changes(changes, ["id"])

