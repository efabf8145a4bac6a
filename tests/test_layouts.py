"""Keyed tables, checksums of key ranges, containment search, the gate in the writing pass."""

import contextlib
import io
import random
import re

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from finlake import sinks, tables
from finlake.functions import contained
from finlake.operators import audit, checksums, lineage, quality
from finlake.operators.latest import upsert

ROW = "id long, saldo double, nota string"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def named(spark):
    names = ["contas_teste", "contas_teste_anterior", "contas_teste_novo"]

    def drop():
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")

    drop()
    yield names[0]
    drop()


def target(spark, n=500):
    return spark.createDataFrame([(i, float(i), None if i % 3 else "x") for i in range(n)], ROW)


def updates(spark):
    return spark.createDataFrame([(i, -1.0 * i, None) for i in range(450, 600)] + [(460, 7.0, "later")], ROW)


def test_target_tables_are_laid_out_for_their_key(spark, named, tmp_path):
    schema = sinks.create_target_table(spark, named, {"id": "bigint", "saldo": "decimal", "nome": "varchar"}, str(tmp_path), buckets=8)
    assert tables.layout(spark, named) == (["id"], ["id", "created_at"], 8)
    assert [f.name for f in schema] == ["id", "saldo", "nome", "created_at"] and spark.table(named).columns == [f.name for f in schema]
    sinks.create_target_table(spark, named, {"id": "bigint"}, str(tmp_path))  # there already
    assert spark.table(named).count() == 0


def test_merges_move_the_updates_only(spark, named, tmp_path):
    tables.write_keyed(target(spark), named, ["id"], buckets=8, path=str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(tables.merge_rows(spark.table(named), updates(spark), ["id"], ["nota"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The scan of the table reaches the join by a sort alone.
    assert "SelectedBucketsCount: 8 out of 8" in text and "SortMergeJoin FullOuter" in text
    tree = text.split("\n\n")[0]
    scan = next(i for i, line in enumerate(tree.splitlines()) if "Scan parquet" in line)
    join = next(i for i, line in enumerate(tree.splitlines()) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in tree.splitlines()[join:scan])
    expected = rows(upsert(target(spark), updates(spark), ["id"], ["nota"]))
    for _ in range(2):  # a repeated merge changes nothing
        tables.merge_into(spark, named, updates(spark), ["nota"], str(tmp_path))
        assert rows(spark.table(named)) == expected
        assert tables.layout(spark, named) == (["id"], ["id"], 8)


def test_a_broken_merge_is_mended(spark, named, tmp_path):
    tables.write_keyed(target(spark, 20), named, ["id"], ["saldo"], buckets=4)
    spark.sql(f"ALTER TABLE {named} RENAME TO {named}_anterior")  # broken off between the renames
    tables.merge_into(spark, named, updates(spark).where("id < 455"), ["nota"])
    assert rows(spark.table(named)) == rows(upsert(target(spark, 20), updates(spark).where("id < 455"), ["id"], ["nota"]))
    assert tables.layout(spark, named) == (["id"], ["id", "saldo"], 4)


def test_merged_rows_with_null_keys_and_values(spark):
    old = spark.createDataFrame([(None, 1.0, "a"), (1, None, "b"), (2, 2.0, None)], ROW)
    new = spark.createDataFrame([(None, 9.0, "n"), (1, None, None), (3, 3.0, "c")], ROW)
    assert rows(tables.merge_rows(old, new, ["id"])) == rows(spark.createDataFrame(
        [(None, 1.0, "a"), (None, 9.0, "n"), (1, None, None), (2, 2.0, None), (3, 3.0, "c")], ROW))


def copies(spark, seed=3, n=5000):
    rng = random.Random(seed)
    old = [(i, rng.choice([None, float(rng.randint(0, 5))]), rng.choice([None, "", "a", "b"])) for i in range(n)] + [(None, 1.0, "k")]
    new = [r for r in old if r[0] is None or r[0] % 501] + [(n + 3, 1.0, "new")]
    new = [(i, 99.0 if i == 77 else v, None if i == 78 else t) for i, v, t in new]

    return spark.createDataFrame(old, ROW), spark.createDataFrame(new, ROW)


def test_changes_by_ranges_equal_the_whole_comparison(spark):
    old, new = copies(spark)
    whole = rows(audit.long_changes(audit.changed_fields(old, new, ["id"]), ["id"]))
    assert rows(audit.long_changes(checksums.changed_by_ranges(old, new, ["id"]), ["id"])) == whole and len(whole) > 10
    assert rows(audit.long_changes(checksums.changed_by_ranges(old, new, ["id"], (3,)), ["id"])) == whole
    moved = [df.count() for df in checksums.differing_rows(old, new, ["id"])]
    assert max(moved) < 40  # a dozen differences, not five thousand rows
    left, right = checksums.differing_rows(old, old, ["id"])
    assert left.count() == right.count() == 1  # only the row without a key


def test_ranges_see_nulls_moved_between_columns_and_other_columns(spark):
    schema = "id long, a string, b string"
    old, new = spark.createDataFrame([(1, "x", None), (2, None, "")], schema), spark.createDataFrame([(1, None, "x"), (2, "", None)], schema)
    assert checksums.differing_ranges(old, new, ["id"], 10).count() == 2
    wider = old.withColumn("c", F.lit(None).cast("string"))
    assert checksums.differing_ranges(old, wider, ["id"], 10).count() == 0
    assert rows(checksums.changed_by_ranges(old, wider.withColumn("c", F.lit("z")), ["id"]).select("id")) == [(1,), (2,)]
    assert checksums.differing_ranges(old.limit(0), old, ["id"], 10).count() == 2


def test_containment_by_index_equals_all_pairs(spark):
    rng = random.Random(6)
    pieces = ["conta", "contas", "cliente", "PIX", "pix_", "a", "ab", "schema.tabela", " ", "\n", "\t", ",", "é", "x" * 30]
    texts = [None, "", " "] + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(120)]
    names = [None, "", "  ", "a", "b", "AB", "contas", "conta cliente", "tas\n", "pix_a", "éa", "x" * 29, "zz", "zzz", "a.tab", "conta", "conta"]
    names += ["".join(rng.choice(pieces) for _ in range(2)).strip() for _ in range(60)]
    views = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "view_name long, definition string")
    listed = spark.createDataFrame([(n,) for n in names], "table_name string")
    expected = sorted({(n, i) for n in names if n and n.strip() for i, t in enumerate(texts) if t is not None and n.lower() in t.lower()})
    assert sorted(map(tuple, lineage.view_edges(views, listed).collect())) == expected and len(expected) > 100


def test_names_of_several_parts_meet_texts_at_their_seams(spark):
    """A frequent part alone brings no text and name together: texts give only seams that some name has."""
    texts = ["the of", "sothe often", "of the", "the  of", "a b c", "xa b cx", "a b", "", None, "the", "é ó à"]
    names = ["the of", "he o", "the  of", "b c", "a b c", " of", "é ó", "the zz", "e t", "ó  à", "\tthe"]
    views = spark.createDataFrame([*enumerate(texts), (1, "the of")], "view_name long, definition string")
    listed = spark.createDataFrame([(n,) for n in names], "table_name string")
    got = lineage.view_edges(views, listed)
    expected = {(n, i) for n in names for i, t in [*enumerate(texts), (1, "the of")] if t is not None and n in t}
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert "Subquery" in plan(got)
    seams = spark.createDataFrame([(["the", "of", "the", "of", "x"],)], "w array<string>").select(lineage._seams(F.col("w")).alias("s")).head().s
    assert seams == ["the of", "of the", "of x"]


def test_pairs_are_made_where_the_texts_lie(spark):
    """No word, text or pair is dealt out, but keys with several texts have these together, with very many their pairs."""
    views = spark.createDataFrame([(1, "The of a"), (2, "sothe often"), (2, "the of"), (3, None), (None, "the")], "view_name long, definition string")
    listed = spark.createDataFrame([(n,) for n in ("the", "THE", "e of", "of", "of a", "a", None, " ")], "table_name string")
    found = lineage.view_edges(views, listed)
    text = plan(found)
    tree = text.split("\n\n")[0]
    assert "Join" not in text and tree.count("MapInArrow") == 3
    once, few, many = re.split(r"(?m)^   [:+]- ", tree)[1:]
    assert "Exchange" not in once and few.count("Exchange") == 1 and many.count("Exchange") == 1
    assert few.index("MapInArrow") < few.index("Exchange") and many.index("Exchange") < many.index("MapInArrow")
    expected = {(n, 1) for n in ("the", "THE", "e of", "of", "of a", "a")} | {(n, 2) for n in ("the", "THE", "e of", "of")}
    assert sorted(map(tuple, found.collect())) == sorted(expected)


@pytest.mark.parametrize("most, texts_together, ignore_case", [(500_000, 16, True), (20, 8, False)])
def test_names_in_several_passes_equal_all_pairs(spark, monkeypatch, most, texts_together, ignore_case):
    monkeypatch.setattr(lineage, "MOST_NAMES", most)
    monkeypatch.setattr(lineage, "MOST_TEXTS", texts_together)
    rng = random.Random(11)
    pieces = ["ab", "a", "B", "é", " ", " ", "  ", "\t", "x" * 33, "abc", "\u00a0"]
    made = lambda most: "".join(rng.choice(pieces) for _ in range(rng.randint(1, most)))
    names = [made(6) for _ in range(60)] + ["a b ab", " a", "ab ", "x" * 35, None, "\n"]
    texts = [(rng.choice(["k", "l", "l", "l", "m", None]) if i % 3 else f"v{i}", None if i % 17 == 4 else made(25)) for i in range(60)]
    views = spark.createDataFrame(texts, "view_name string, definition string")
    low = str.lower if ignore_case else str
    expected = {(n, k) for n in names if n and n.strip(" \t\n") for k, t in texts if k is not None and t is not None and low(n) in low(t)}
    listed = spark.createDataFrame([(n,) for n in names], "table_name string")
    got = lineage.contained_names(views, listed, "view_name", "definition", "table_name", ignore_case)
    assert sorted(map(tuple, got.collect())) == sorted(expected) and len(expected) > 100
    assert got.schema.simpleString() == "struct<table_name:string,view_name:string>"


def test_names_and_keys_keep_their_types(spark):
    log = spark.createDataFrame([("2024-01-31", "a 12 b"), ("2024-02-01", "312")], "day string, t string").select(F.col("day").cast("date").alias("day"), "t")
    numbers = spark.createDataFrame([(12,), (31,), (4,), (None,)], "n int")
    got = lineage.contained_names(log, numbers, "day", "t", "n")
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "date"]
    assert sorted((n, str(d)) for n, d in got.collect()) == [(12, "2024-01-31"), (12, "2024-02-01"), (31, "2024-02-01")]
    assert lineage.contained_names(log, numbers.where("n < 0"), "day", "t", "n").count() == 0


def test_the_tree_of_names_equals_a_search_for_each(monkeypatch):
    for seed in range(300):
        rng = random.Random(seed)
        monkeypatch.setattr(contained, "PLACES", rng.choice([1, 7, 1 << 17]))
        monkeypatch.setattr(contained, "DENSE", rng.choice([1, 5, 4096]))
        made = lambda most: "".join(rng.choice(["a", "b", "ab", " ", "  ", "\n", "é", "\u00a0", "aab"]) for _ in range(rng.randint(0, most))).encode()
        names, texts = [made(6) for _ in range(rng.choice([0, 1, 40]))], [made(25) for _ in range(6)]
        offsets = np.cumsum([0] + [len(t) for t in texts])
        got = list(zip(*(x.tolist() for x in contained.NameIndex(names).contained(np.frombuffer(b"".join(texts), np.uint8), offsets))))
        assert sorted(got) == [(row, i) for row, t in enumerate(texts) for i, n in enumerate(names) if n and n in t]


def test_records_lineage_keeps_the_case(spark):
    log = spark.createDataFrame(
        [(1, "t", '{"id":"Ab1"}', None), (2, "t", None, "ab1"), (3, "u", "Ab1", None), (4, "t", "x", "zAb1z")],
        "id long, table_name string, changes string, deleted_data string")
    ids = spark.createDataFrame([("Ab1",), ("ab1",), ("none",)], "record_id string")
    assert rows(audit.records_lineage(log, ids, "t")) == [("Ab1", 1), ("Ab1", 4), ("ab1", 2)]


SUITE = [
    quality.not_null("id"), quality.unique("id"), quality.in_set("nota", "x", "y"), quality.between("saldo", 0, 100), quality.row_count(1, 1000),
    quality.matches("nota", "^[a-z]$"), quality.not_null("ausente"),
]


@pytest.mark.parametrize("rows_in", [
    [(1, 1.0, "x"), (2, 2.0, None)], [(1, 1.0, "x"), (1, 200.0, "q"), (None, -1.0, "Z"), (3, 1.0, "q")], [],
])
def test_the_gate_reads_the_source_once(spark, tmp_path, rows_in):
    source = spark.createDataFrame(rows_in, ROW)
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    def write(df):
        df.write.mode("overwrite").parquet(str(tmp_path / "silver"))
        return spark.read.parquet(str(tmp_path / "silver"))

    results = []
    original = quality.assert_quality
    quality.assert_quality = lambda found, layer: results.append(found)
    try:
        found = quality.write_checked(source.mapInArrow(count, ROW), "t", SUITE, write, "silver")
    finally:
        quality.assert_quality = original
    assert rows(found) == rows(quality.run_suite(source, "t", SUITE))
    assert passed.value == len(rows_in) and results == [found]


def test_a_failed_gate_raises_after_the_write(spark, tmp_path):
    def write(df):
        df.write.parquet(str(tmp_path / "s"))
        return spark.read.parquet(str(tmp_path / "s"))

    good, bad = SUITE[:1], [quality.between("saldo", 50, 60)]
    source = target(spark, 5)
    with pytest.raises(RuntimeError, match=re.escape("quality gate prata failed")):
        quality.write_checked(source, "t", bad, write, "prata")
    assert quality.write_checked(spark.read.parquet(str(tmp_path / "s")), "t", good, lambda df: df.cache(), "ouro").count() == 1
