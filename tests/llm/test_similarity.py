"""Jaccard join and decontamination against brute force and SQL."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from finlake.llm import common, jaccard
from finlake.llm.decontaminate import contamination, winnowed
from finlake.llm.jaccard import join_region, similarity_classes
from finlake.llm.queries import ORACLE, QUERIES

from .helpers import ODD, SF, docs_of, documents, oracle, records


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def classes(rows):
    """component of each row by brute force over all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if union and 100 * len(sets[i] & sets[j]) >= 75 * union:
                root[find(i)] = find(j)
    best = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            best[find(i)] = min(name, best.get(find(i), name))
    return sorted(((n, len(sets[i]), n if not sets[i] else best.get(find(i))) for i, (n, _) in enumerate(rows)), key=repr)


def found_classes(df):
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def link_counts(rows):
    """Number of other rows each row links with, by brute force."""
    sets = [shingles(t) for _, t in rows]
    counts = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if union and 100 * len(sets[i] & sets[j]) >= 75 * union:
                counts[i] += 1
                counts[j] += 1
    return sorted(zip((n for n, _ in rows), counts, strict=True), key=repr)


def near_copies(seed, documents, words):
    """Copies of one text with up to two words replaced, some texts more than once."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(documents):
        text = list(base)
        for _ in range(rng.randrange(3)):
            text[rng.randrange(words)] = f"e{rng.randrange(50)}"
        rows += [(1000 + i, " ".join(text))] * (1 + (i % 9 == 0))
    return rows


def varied(seed, documents, words, edits):
    """Groups of documents that drift apart edit by edit, some around a shared passage."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for group in range(documents // 6):
        text = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(words // 2, words))]
        if group % 2:
            text[3:3] = passage
        for _ in range(6):
            text = list(text)
            for _ in range(rng.randrange(edits)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_similarity_classes_of_drifting_groups(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "SEEN", 3)
    rows = varied(seed, 90, 60, 4) + ODD + [(500, "one two three"), (501, "One two\nthree"), (502, "one two three four")]
    assert found_classes(similarity_classes(docs_of(spark, rows))) == classes(rows)


def test_large_regions_take_levels_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "REGION_SHINGLES", 150)
    monkeypatch.setattr(jaccard, "LEVELS", 1)
    monkeypatch.setattr(jaccard, "SEEN", 3)
    rows = varied(3, 60, 40, 4)
    assert found_classes(similarity_classes(docs_of(spark, rows))) == classes(rows)


@pytest.mark.parametrize("limits", [{}, {"FEW": 8}, {"FEW": 8, "REGION_WORK": 20_000}, {"FEW": 8, "REGION_SHINGLES": 400, "REGION_WORK": 5_000, "LEVELS": 1}])
def test_every_link_is_counted_once(spark, monkeypatch, limits):
    for name, value in {"SEEN": 3, **limits}.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = near_copies(5, 60, 60) + varied(6, 48, 50, 4) + ODD
    found = similarity_classes(docs_of(spark, rows)).collect()
    assert sorted(((r["id"], r["n_links"]) for r in found), key=repr) == link_counts(rows)
    assert max(n for _, n in link_counts(rows)) > 40


def test_only_regions_of_few_go_to_the_sketch_test(spark, monkeypatch):
    seen, possible = [], jaccard._possible

    def spied(members, percent):
        seen.extend(r["count"] for r in members.groupBy("pivot").count().collect())
        return possible(members, percent)

    monkeypatch.setattr(jaccard, "FEW", 8)
    monkeypatch.setattr(jaccard, "_possible", spied)
    rows = near_copies(9, 40, 60) + varied(10, 24, 50, 3)
    found = similarity_classes(docs_of(spark, rows))
    assert found_classes(found) == classes(rows)
    assert 1 < min(seen) <= max(seen) <= 8


def test_similarity_classes_of_nothing(spark):
    assert similarity_classes(docs_of(spark, ODD).limit(0)).count() == 0
    assert [r["component_id"] for r in similarity_classes(docs_of(spark, [(1, None), (2, "")])).orderBy("id").collect()] == [1, 2]


def test_similarity_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in QUERIES["op5_jaccard_join"](spark, SF).collect()), key=repr)
    assert got == classes(rows)


@pytest.mark.parametrize("stage", ["near_copy_stage", "benchmark_stage"])
def test_stages_do_not_depend_on_how_a_scan_splits(spark, tmp_path, stage):
    """The result is planned with other file splits than the jobs before it."""
    rows = varied(8, 48, 40, 2) + [(900 + i, f"hit{i} " + " ".join(f"b{j}" for j in range(12))) for i in range(6)]
    docs_of(spark, rows).repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"b{j}" for j in range(12)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    first = {n: c for n, _, c in classes(rows)}
    expected = sorted(n for n, _ in rows if (n == first[n] if stage == "near_copy_stage" else n < 900))
    name = "spark.sql.files.maxPartitionBytes"
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        kept = getattr(corpus_pipeline, stage)(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
        spark.conf.set(name, "1k")
        assert sorted(r["doc_id"] for r in kept.collect()) == expected
    finally:
        for key in (name, "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"):
            spark.conf.unset(key)


def test_join_region_keeps_connection():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 10**6, 40)
    sets = [np.unique(np.concatenate([base[i % 7 :], rng.integers(0, 10**6, i % 11)])).astype(np.uint64) for i in range(40)]

    def groups(links):
        root = list(range(40))
        for a, b in links:
            a, b = root[a], root[b]
            root = [min(a, b) if r in (a, b) else r for r in root]
        return root

    every = [(i, j) for i in range(40) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
    assert groups(join_region(list(range(40)), sets, 0, 75)) == groups(every)


def test_winnowing_keeps_one_print_in_every_window():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 20, 200).astype(np.uint64)
    ends = np.repeat([80, 83, 200], [80, 3, 117])
    at = set(winnowed(values, ends, 6).tolist())
    for first, end in ((0, 80), (83, 200)):
        assert all(at & set(range(i, i + 6)) for i in range(first, end - 5))
    assert not at & set(range(80, 83))


def test_decontamination_agrees_with_sql(spark):
    assert records(QUERIES["op4_decontamination"](spark, SF)) == oracle(ORACLE["op4_decontamination"])


def test_decontamination_of_short_items_and_odd_rows(spark):
    words = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame(
        [(1, " ".join(words[:12])), (2, "Short-Item"), (3, None), (4, ""), (5, "!!"), (6, " ".join(words[:12])), (7, "solo"), (None, "no name")],
        "item_id long, text string",
    )
    rows = [
        (10, "x " + " ".join(words[1:11]) + " y"), (11, " ".join(words[:9])), (12, "a SHORT, item! short item"), (13, "Solo"),
        (14, " ".join(words[:30]).upper()), (15, " ".join(words[2:12] + words[2:12])), (16, "no name no name"),
    ]
    found = {r["id"]: r for r in contamination(docs_of(spark, rows + ODD), items).collect()}
    assert (found[10]["n_words"], found[10]["n_hit"], found[10]["item_ids"]) == (12, 10, ["1", "6"])
    assert (found[11]["n_hit"], found[11]["item_ids"]) == (0, [])
    assert (found[12]["n_hit"], found[12]["item_ids"]) == (4, ["2"])
    assert (found[13]["n_hit"], found[13]["item_ids"]) == (1, ["7"])
    assert (found[14]["n_hit"], found[15]["n_hit"]) == (12, 20)
    assert (found[16]["n_hit"], found[16]["item_ids"]) == (4, [""])
    assert (found[1]["n_words"], found[2]["n_words"]) == (0, 0)
    assert contamination(docs_of(spark, rows), items.limit(0)).where("n_hit > 0").count() == 0
    assert contamination(docs_of(spark, rows).limit(0), items).count() == 0


def test_numbers_of_parquet_rows_do_not_follow_the_splits(spark, tmp_path):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit(1).alias("__file"))
    df.repartition(3).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    first = {tuple(r) for r in common.numbered(read, "n", ["doc_id"]).collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again = common.numbered(spark.read.parquet(str(tmp_path / "t")).where("doc_id >= 0"), "n")
        assert again.columns == ["doc_id", "text", "__file", "n"] and {(r["doc_id"], r["n"]) for r in again.collect()} == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(first) == len({n for _, n in first}) == 5000
    other = common.numbered(df.limit(40), "n", ["doc_id"])  # no file scan: written with its numbers
    assert other.columns == ["doc_id", "n"] and len({r["n"] for r in other.collect()}) == 40
    assert common.numbered(read.where("false"), "n").count() == 0
