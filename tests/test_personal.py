"""The gated patterns find what the plain patterns find."""

import random

from conftest import SF, rows
from pyspark.sql import functions as F

from finlake.functions.personal import PII_PATTERNS, contains_pii, pii_count
from finlake.operators import privacy

PARTS = [
    "123.456.789-09", "12.345.678/0001-95", "ana.b+c@ex-a.com.br", "(11) 98765-4321", "1234 5678 9012 3456", "12345-6", "1.234.567-8",
    "1234-5678-9", "@", "-", ".", "/", "(", ")", " ", "\n", "\u00a0", "\u0663\u0664\u0665\u0666-\u0667", "a@b.c", "a@@b.co", "x.y@z.zz|", "\u00e9@e.ee", "9", "12",
]


def texts(n):
    rng = random.Random(8)
    return [None, ""] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 8))) for _ in range(n)]


def test_gated_patterns_equal_plain_ones(spark):
    df = spark.createDataFrame([(t,) for t in texts(6000)], "t string").repartition(4)
    t = F.col("t")
    anything = F.coalesce(t.rlike("(?U)" + "|".join(f"(?:{p})" for p in PII_PATTERNS.values())), F.lit(False))
    checks = [(contains_pii(t) != anything).alias("any")]
    for kind, pattern in PII_PATTERNS.items():
        checks.append((pii_count(t, kind) != F.coalesce(F.regexp_count(t, F.lit(f"(?U){pattern}")), F.lit(0))).alias(kind))
    wrong = df.select(*[F.count_if(c).alias(f"w{i}") for i, c in enumerate(checks)], F.count_if(anything).alias("n"), F.count_if(~anything).alias("m")).first()
    assert list(wrong)[:-2] == [0] * len(checks) and wrong["n"] > 500 and wrong["m"] > 500


def test_matches_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "12345-6 12345-7", "a@b.co"), (2, None, "")], "_key_0 long, _text_0 string, `odd name` string")
    got = privacy.pii_matches(df, ["_key_0"])
    assert rows(got.select("_key_0", "qtd_bank_account", "qtd_email")) == [(1, 2, 1), (2, 0, 0)]


def test_documents_are_classified_as_before(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    anything = F.coalesce(F.col("text").rlike("(?U)" + "|".join(f"(?:{p})" for p in PII_PATTERNS.values())), F.lit(False))
    assert docs.where(contains_pii(F.col("text")) != anything).count() == 0 and docs.where(anything).count() > 0
