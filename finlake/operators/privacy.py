"""Personal-data jobs: classification, masking, subjects, retention, compliance report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AsOf, moment
from ..functions.frames import side_by_side
from ..functions.personal import (
    MASKS,
    PERMANENT,
    PII_PATTERNS,
    column_sensitivity,
    contains_pii,
    dashed_number,
    mask_hash,
    pii_count,
    retention_days,
    sensitivity,
)
from .latest import latest_by_key


def _text_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    names = columns if columns is not None else df.columns
    return [c for c in names if c in df.columns and df.schema[c].dataType.typeName() == "string"]


def fields_with_pii(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    hits = [contains_pii(F.col(c)).cast("int") for c in _text_columns(df, columns)]
    return reduce(lambda a, b: a + b, hits, F.lit(0))


def classify_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Adds the number of text fields with personal data and the level that follows."""
    return df.withColumn("campos_pii", fields_with_pii(df, columns)).withColumn(
        "classificacao", sensitivity(F.col("campos_pii"))
    )


def pii_matches(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Matches of every pattern per row, over all text columns, whole texts.

    Whether a text has a dashed number at all is found once; most texts have none and are read no further for those kinds.
    """
    names = _text_columns(df, columns)
    gates = {c: f"_dashed_{i}" for i, c in enumerate(names)}
    texts = df.select(
        *[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)],
        *[F.col(f"`{c}`").alias(f"_text_{i}") for i, c in enumerate(names)],
        *[dashed_number(F.col(f"`{c}`")).alias(g) for c, g in gates.items()],
    )

    def total(kind: str) -> Column:
        counts = [pii_count(F.col(f"_text_{i}"), kind, F.col(f"_dashed_{i}")) for i in range(len(names))]
        return reduce(lambda a, b: a + b, counts, F.lit(0))

    return texts.select(
        *[F.col(f"_key_{i}").alias(k) for i, k in enumerate(keys)], *[total(kind).alias(f"qtd_{kind}") for kind in PII_PATTERNS]
    )


def pii_columns(df: DataFrame) -> DataFrame:
    """Rows with personal data per text column, from one scan of the values."""
    names = _text_columns(df, None)
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(contains_pii(F.col(c))).alias(c) for c in names])
    entries = [
        F.struct(F.lit(c).alias("coluna"), F.col(c).alias("linhas_pii"), F.col("total").alias("linhas")) for c in names
    ]
    found = counts.select(F.inline(F.array(*entries)))
    return found.withColumn("classificacao", F.when(F.col("linhas_pii") > 0, "PII").otherwise("NORMAL"))


def anonymize(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Masked copies of the named fields; names the table lacks are ignored."""
    masked = {f: MASKS.get(f, mask_hash)(F.col(f).cast("string")) for f in fields if f in df.columns}
    return df.withColumns(masked) if masked else df


def data_subjects(people: DataFrame, order: Sequence[str], as_of: AsOf = None) -> DataFrame:
    """One subject per (cpf, email), the last row by ``order`` winning."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in people.columns else F.lit("")

    source = [c for c in people.columns if c not in order]
    consent = F.coalesce(F.col("consent_given"), F.lit(False)) if "consent_given" in people.columns else F.lit(False)
    level = sensitivity(fields_with_pii(people, source))
    rows = people.select(
        F.sha2(F.concat(text("cpf"), text("email")), 256).alias("id"),
        *[text(c).alias(c) for c in ("name", "email", "cpf", "phone", "address")],
        level.alias("data_classification"),
        consent.alias("consent_given"),
        moment(as_of).alias("consent_date"),
        *order,
    )
    newest = latest_by_key(rows, ["id"], list(order)).drop(*order)
    return newest.withColumn("data_retention", retention_days(F.col("data_classification")))


def processing_records(records: DataFrame, subjects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with what they inherit from their subject, records of unknown subjects)."""
    known = subjects.select(F.col("id").alias("data_subject_id"), "data_classification", "data_retention")
    stamp = F.date_format("processing_date", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    joined = records.join(known, "data_subject_id").select(
        F.sha2(F.concat("data_subject_id", "processing_purpose", stamp), 256).alias("id"),
        *records.columns,
        F.col("data_retention").alias("retention_period"),
        F.col("data_classification").isin("confidential", "restricted").alias("anonymization_required"),
    )
    return joined, records.join(known, "data_subject_id", "left_anti")


def _expiration() -> Column:
    return F.col("processing_date") + F.make_dt_interval(days=F.col("retention_period"))


def _is_expired(as_of: AsOf) -> Column:
    return (F.col("retention_period") != PERMANENT) & (moment(as_of) > _expiration())


def expired_records(records: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Records past their retention, with whole days overdue; permanent ones never expire."""
    overdue = F.unix_micros(moment(as_of)) - F.unix_micros(_expiration())
    return records.where(_is_expired(as_of)).select(
        F.col("id").alias("record_id"), "data_subject_id", "processing_purpose", _expiration().alias("expiration_date"),
        F.floor(overdue / 86_400_000_000).cast("int").alias("days_overdue"),
    )


def data_inventory(subjects: DataFrame, records: DataFrame) -> DataFrame:
    """Inventory as (metrica, chave, total) rows: totals, distributions, purposes, categories."""

    def sides(df: DataFrame, dimensions: dict[str, str], total: str, lists: dict[str, str]) -> DataFrame:
        # One pass: every row counts once per dimension, list element and total.
        def entry(name: str, value: Column) -> Column:
            return F.struct(F.lit(name).alias("metrica"), value.cast("string").alias("chave"))

        def listed_entries(name: str, values: Column) -> Column:
            return F.transform(values, lambda x: entry(name, x))

        entries = F.array(entry(total, F.lit(None)), *[entry(name, F.col(c)) for name, c in dimensions.items()])
        for name, c in lists.items():
            listed = F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType))
            entries = F.concat(entries, listed_entries(name, listed))
        return df.select(F.inline(entries)).groupBy("metrica", "chave").agg(F.count(F.lit(1)).alias("total"))

    return sides(
        subjects,
        {"classification_distribution": "data_classification", "retention_distribution": "data_retention"},
        "total_data_subjects",
        {},
    ).unionByName(
        sides(
            records,
            {"legal_basis_distribution": "legal_basis", "processing_purposes": "processing_purpose"},
            "total_processing_records",
            {"data_categories": "data_categories"},
        )
    )


def compliance_report(subjects: DataFrame, records: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row: status, counts and recommendations. The expired rows are ``expired_records``."""
    s = subjects.agg(
        F.count(F.lit(1)).alias("subjects"),
        F.count_if(F.col("data_classification") == "restricted").alias("restricted"),
        F.count_if(F.col("data_retention") == PERMANENT).alias("permanent"),
    )
    r = records.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("legal_basis") == "consent").alias("consent"),
        F.count_if(_is_expired(as_of)).alias("expired"),
    )
    advice = F.array_compact(
        F.array(
            F.when(
                F.col("expired") > 0,
                F.concat(F.lit("Remover "), F.col("expired").cast("string"), F.lit(" registros de dados expirados")),
            ),
            F.when(F.col("restricted") > 100, F.lit("Considerar anonimização de dados restritos")),
            F.when(F.col("consent") < F.col("records") * 0.5, F.lit("Aumentar uso de consentimento explícito")),
            F.when(F.col("permanent") > F.col("subjects") * 0.3, F.lit("Revisar política de retenção permanente")),
        )
    )
    return side_by_side(s, r).select(
        F.when(F.col("expired") == 0, "COMPLIANT").otherwise("NON_COMPLIANT").alias("compliance_status"),
        F.col("subjects").alias("total_data_subjects"),
        F.col("records").alias("total_processing_records"),
        F.col("expired").alias("expired_data_count"),
        advice.alias("recommendations"),
    )


def classify_columns(catalogue: DataFrame) -> DataFrame:
    """Level of every column of a (table_name, column_name, ...) catalogue, by its name."""
    return catalogue.withColumn("classification", column_sensitivity(F.col("column_name")))


def classify_datasets(catalogue: DataFrame) -> DataFrame:
    """A dataset is personal when one of its columns is."""
    hit = F.col("classification") == "PII"
    return classify_columns(catalogue).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_columns"),
        F.count_if(hit).alias("pii_columns"),
        F.when(F.max(hit), "PII").otherwise("NORMAL").alias("classification"),
    )
