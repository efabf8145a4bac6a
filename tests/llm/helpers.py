"""Shared fixtures of the text operators' tests: odd rows, and tables with clashing column names."""

import duckdb

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns named like the operators' own ones.
EXTRA = "row long, id long, score double, kept boolean, n_tokens long, key string, digest string, n long"


def docs_of(spark, rows, extra=True):
    """documents from (doc_id, text[, lang]) tuples, with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    if not extra:
        return spark.createDataFrame(full, SCHEMA)
    return spark.createDataFrame([r + (7, 7, 0.5, None, 3, "k", "d", 1) for r in full], f"{SCHEMA}, {EXTRA}")


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "é" * 50), (None, "no id here at all"), (6, "a b c d e f"), (6, "a b c d e f")]


def documents(spark, table="documents"):
    return spark.read.parquet(f"{SF}/{table}.parquet")


def oracle(sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    return sorted(tuple(sorted(zip(names, r, strict=True))) for r in cursor.fetchall())


def records(df):
    return sorted(tuple(sorted(r.asDict().items())) for r in df.collect())
