"""Quality, personal data, audit, reconciliation, lineage."""

from datetime import datetime

import pytest
from conftest import rows

from finlake.operators import audit, lineage, privacy, quality, reconcile
from finlake.operators.features import CATALOGUE


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            ("Ana", "123.456.789-00", "ana@example.com", "(11) 91234-5678", "a"),
            ("Bia", "123.456.789-00", "bia@example.com", "", "b"),
            ("Caio", "", "caio@example.com", None, "c"),
            ("Davi", "", "", "", "d"),
        ],
        "name string, cpf string, email string, phone string, address string",
    )


def test_row_levels(people):
    out = privacy.classify_rows(people)
    assert rows(out.select("name", "classificacao")) == [
        ("Ana", "restricted"), ("Bia", "confidential"), ("Caio", "internal"), ("Davi", "public")]


@pytest.mark.parametrize("text,kind", [
    ("x 123.456.789-00", "cpf"), ("12.345.678/0001-90", "cnpj"), ("a.b@c.org", "email"), ("(11) 1234-5678", "phone"),
    ("1234 5678 9012 3456", "credit_card"), ("12345-6", "bank_account"), ("1.234.567-8", "rg")])
def test_each_pattern(spark, text, kind):
    df = spark.createDataFrame([(1, text), (2, "nada"), (3, None)], "id int, t string")
    assert rows(privacy.pii_matches(df, ["id"]).select("id", f"qtd_{kind}")) == [(1, 1), (2, 0), (3, 0)]


def test_masks(spark):
    df = spark.createDataFrame(
        [("12345678901", "joao.silva@example.com", "11912345678", "Joao Silva", "x"),
         ("123", "sem arroba", "123", "Joao", None)],
        "cpf string, email string, phone string, name string, other string")
    a, b = privacy.anonymize(df, ["cpf", "email", "phone", "name", "other", "absent"]).collect()
    assert tuple(a)[:4] == ("***.***.***-01", "jo***@example.com", "(11) ***-5678", "Joao S***")
    assert len(a.other) == 8 and b.name == "J***" and b.other is None
    assert all(len(v) == 8 for v in (b.cpf, b.email, b.phone))


def test_subjects_records_and_expiry(spark, people):
    stamped = people.selectExpr("*", "1 AS ord").unionByName(
        people.where("name = 'Ana'").selectExpr("'Ana 2' AS name", "cpf", "email", "phone", "address", "2 AS ord"))
    subjects = privacy.data_subjects(stamped, ["ord"], "2024-01-01")
    assert rows(subjects.select("name", "data_retention")) == [
        ("Ana 2", 2555), ("Bia", 365), ("Caio", 30), ("Davi", 30)]
    ids = {r.name: r.id for r in subjects.collect()}
    when = datetime(2024, 1, 1)
    records = spark.createDataFrame(
        [(ids["Caio"], "p", "consent", ["x"], when, "s"), (ids["Ana 2"], "p", "contract", ["x", "y"], when, "s"),
         ("nobody", "p", "consent", [], when, "s")],
        "data_subject_id string, processing_purpose string, legal_basis string, data_categories array<string>, "
        "processing_date timestamp, processor string")
    known, unknown = privacy.processing_records(records, subjects)
    assert rows(known.select("retention_period", "anonymization_required")) == [(2555, True), (30, False)]
    assert rows(unknown.select("data_subject_id")) == [("nobody",)]
    late = privacy.expired_records(known, "2025-02-04")
    assert rows(late.select("days_overdue")) == [(370,)]
    assert privacy.expired_records(known, "2024-01-31").count() == 0
    assert privacy.expired_records(known.selectExpr("* EXCEPT (retention_period)", "-1 AS retention_period"), "2099-01-01").count() == 0
    report = privacy.compliance_report(subjects, known, "2025-02-04").head()
    assert (report.compliance_status, report.expired_data_count) == ("NON_COMPLIANT", 1)
    assert report.recommendations == ["Remover 1 registros de dados expirados"]
    empty = privacy.compliance_report(subjects.where("false"), known.where("false"), "2025-01-01").head()
    assert (empty.compliance_status, empty.recommendations) == ("COMPLIANT", [])
    inventory = {(r.metrica, r.chave): r.total for r in privacy.data_inventory(subjects, known).collect()}
    assert inventory[("total_data_subjects", None)] == 4 and inventory[("data_categories", "x")] == 2


def test_column_catalogue(spark):
    cat = spark.createDataFrame([("t", "email_contato"), ("t", "saldo"), ("u", "id")], "table_name string, column_name string")
    assert rows(privacy.classify_datasets(cat)) == [("t", 2, 1, "PII"), ("u", 1, 0, "NORMAL")]


def test_every_check_and_null_rule(spark):
    df = spark.createDataFrame(
        [(1, "A", 5.0, "12345", 2, 1), (1, "B", 11.0, None, 1, 2), (None, None, None, "x", None, 1), (None, "Z", 1.0, "999999", 3, 3)],
        "id int, s string, v double, r string, a int, b int")
    suite = [
        quality.not_null("id"), quality.unique("id"), quality.in_set("s", "A", "B"), quality.matches("r", r"^\d{5,6}$"),
        quality.between("v", 1, 10), quality.row_count(1, 3), quality.length_between("r", 5, 5), quality.pair_greater("a", "b"),
        quality.not_null("missing"), quality.Expectation("expect_magic", "id"), quality.unique("s"),
    ]
    out = {r.posicao: r for r in quality.run_suite(df, "t", suite).collect()}
    assert [out[i].falhas for i in range(8)] == [2, 2, 1, 1, 1, 1, 2, 2]
    assert out[1].amostra == ["None", "1"] or out[1].amostra == ["1", "None"]
    assert out[2].amostra == ["Z"]
    assert not out[8].passou and "missing" in out[8].erro
    assert not out[9].passou and "unknown" in out[9].erro
    assert out[10].passou and out[10].total_linhas == 4


def test_suites_and_gate(spark):
    assert {t: len(s) for t, s in quality.SUITES.items()} == {
        "contas": 12, "clientes": 11, "transacoes": 11, "pix_pagamentos": 7, "credito_solicitacoes": 5}
    df = spark.createDataFrame([(1, "CONSIGNADO", 500.0, 12, "APROVADO")],
                               "id int, tipo_credito string, valor_solicitado double, prazo_meses int, status string")
    results, skipped = quality.run_all(spark, {"credito_solicitacoes": df}, ["credito_solicitacoes", "silver_contas"])
    assert skipped == ["silver_contas"]
    assert tuple(quality.quality_report(results).head()) == (5, 5, 0, 100.0)
    quality.assert_quality(results, "bronze")
    missing, _ = quality.run_all(spark, {}, ["pix_pagamentos"])
    with pytest.raises(RuntimeError):
        quality.assert_quality(missing, "silver")


def test_changed_fields(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "k int, x string, y int")
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (4, "d", 4)], "k int, x string, y int")
    got = rows(audit.long_changes(audit.changed_fields(old, new, ["k"]), ["k"]))
    assert got == sorted([(2, "MODIFY", "y", None, "5"), (3, "DELETE", "x", "c", None), (3, "DELETE", "y", "3", None),
                          (4, "INSERT", "x", None, "d"), (4, "INSERT", "y", None, "4")], key=repr)
    log = audit.audit_modifications(old, new, ["k"], "t", "u", "2024-01-01").unionByName(
        audit.audit_deletions(old.where("k = 3"), ["k"], "t", "u", "2024-01-01"))
    assert log.select("id").distinct().count() == 4
    assert audit.record_lineage(log, "t", '"5"').count() == 1
    assert audit.record_lineage(log, "t", '"c"').count() == 2
    assert audit.record_lineage(log, "other", "c").count() == 0
    accesses = spark.createDataFrame([("u", datetime(2024, 1, 1))], "user_id string, timestamp timestamp")
    both = log.unionByName(audit.audit_access(accesses, "t"))
    report = {(r.dimensao, r.chave): r.total for r in audit.audit_report(both, end="2024-01-01").collect()}
    assert report[("total_operations", None)] == 5 and report[("operation", "DELETE")] == 1


def frame(spark, n, total, column="saldo"):
    return spark.range(n).selectExpr("id", f"CAST({total} AS DOUBLE) / {n} AS {column}")


def test_reconcile_totals(spark):
    core = {"contas": frame(spark, 100, 5000), "clientes": spark.range(50), "transacoes": frame(spark, 1000, 25000, "valor")}
    same = reconcile.reconcile_totals(core, core)
    assert same.where("diverge").count() == 0
    reconcile.assert_no_divergence(same, "saldos")
    lake = {**core, "contas": frame(spark, 100, 4800)}
    bad = reconcile.reconcile_totals(core, lake)
    assert bad.where("diverge").select("tabela", "divergencia_pct_max").collect() == [("contas", pytest.approx(4.0))]
    with pytest.raises(RuntimeError):
        reconcile.assert_no_divergence(bad, "saldos")
    lake.pop("clientes")
    broken = {r.tabela: r for r in reconcile.reconcile_totals(core, lake).collect()}
    assert broken["clientes"].diverge and broken["clientes"].erro


def test_reconcile_daily_and_metrics(spark):
    def days(spec):
        data = [(datetime(2024, 1, d), 1.0) for d, n in spec.items() for _ in range(n)]
        return spark.createDataFrame(data, "data_atualizacao timestamp, valor double")

    report = reconcile.reconcile_daily(days({1: 120, 2: 5, 3: 1}), days({1: 115, 2: 5, 4: 2}), as_of="2024-01-05")
    got = {r.dia.day: (r.core_n, r.lake_n, r.divergencia_pct) for r in report.collect()}
    assert got == {1: (120, 115, pytest.approx(500 / 120)), 2: (5, 5, 0.0), 3: (1, 0, 100.0), 4: (0, 2, 100.0)}
    fine = report.where("NOT diverge")
    out = {r.escopo: r for r in reconcile.divergence_metrics({"saldos": fine, "transacoes": report}, "2024-01-05").collect()}
    assert (out["saldos"].ok, out["saldos"].divergencia_pct) == (1.0, 0.0)
    assert (out["transacoes"].divergencias, out["transacoes"].divergencia_pct, out["global"].divergencias) == (3, 100.0, 3)


def test_lineage(spark):
    views = spark.createDataFrame([("v1", "SELECT * FROM Contas JOIN clientes"), ("v2", None), ("v3", "SELECT 1")],
                                  "view_name string, definition string")
    assert rows(lineage.view_dependencies(views)) == [("clientes", "v1"), ("contas", "v1")]
    jobs = spark.createDataFrame([("j1", ["a", "b"], ["c"]), ("j2", ["c"], ["d", "e"])], "job string, inputs array<string>, outputs array<string>")
    edges = lineage.job_edges(jobs)
    assert edges.count() == 4
    assert tuple(lineage.pipeline_summary(edges).head()) == (2, 2, 2)


def test_feature_catalogue(spark):
    assert len(CATALOGUE) == 4 and all(len(v.features) == 12 for v in CATALOGUE.values())
    gaps = CATALOGUE["credit_features"].check(spark.createDataFrame([(1, 2)], "conta_id int, saldo_extra int"))
    assert "event_timestamp" in gaps["missing"] and gaps["extra"] == ["saldo_extra"]
