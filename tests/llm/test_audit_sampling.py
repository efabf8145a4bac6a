"""Filter audit, importance resampling and SimHash classes: SQL, brute force, odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm.helpers import ODD, SF, docs_of, documents, oracle, records

from finlake.llm import filter_audit, resampling, simhash
from finlake.llm.queries import ORACLE, QUERIES

LABELS = "doc_id long, quality int, toxic int, id long, good string"


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_importance_resampling"])
def test_query_agrees_with_sql(spark, name):
    assert records(QUERIES[name](spark, SF)) == oracle(ORACLE[name])


def masks_by_hand(docs):
    out = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs),
        }
        out.append((doc_id, lang or "", {k for k, v in fails.items() if v}))
    return out


def audit_by_hand(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    rows, shapley = {}, Counter()
    facts = masks_by_hand(docs)
    for part in {lang for _, lang, _ in facts}:
        for order in itertools.permutations("ABCDE"):
            left = [(i, fails) for i, lang, fails in facts if lang == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                alone = sum(1 for _, lang, fails in facts if lang == part and fails == {letter})
                rows[part, "".join(order), step] = (
                    len(left), len(removed), sum(letter in x[1] for x in gone), alone,
                    sum(i is not None and i in good for i, _ in removed), sum(i is not None and i in toxic for i, _ in removed),
                )
                shapley[part, letter] += len(removed)
                gone += removed
    return {k + v + (shapley[k[0], k[1][k[2] - 1]],) for k, v in rows.items()}


def test_audit_of_odd_rows_by_hand(spark):
    many = " ".join(f"w{i}" for i in range(250))
    docs = [(i, t, "en") for i, t in ODD] + [
        (10, many, "en"), (11, many, "en"), (9, many, None), (12, "LOUD " * 300, ""), (13, "a # b " * 100, "pt"), (None, many, "pt"),
        (None, many, "pt"), (14, many + " É\u0085 x", "pt"), (10, many, "en"), (15, "x\x0by\x0cz " * 30_000, "pt"), (6, "other text", "en"),
    ]
    labels = [(10, 1, 0), (10, 0, 1), (11, 1, None), (9, None, 1), (None, 1, 1), (6, 1, 1), (999, 1, 1)]
    table = docs_of(spark, docs)
    marks = spark.createDataFrame([x + (1, "g") for x in labels], LABELS)
    found = filter_audit.filter_audit(table, marks)
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = [tuple(r) for r in found.collect()]
    assert len(found) == len(set(found)) == 3 * 120 * 5
    assert set(found) == audit_by_hand(docs, labels)


def test_audit_of_empty_tables(spark):
    none = docs_of(spark, [])
    marks = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(none, marks).count() == 0
    found = filter_audit.filter_audit(docs_of(spark, [(1, "$")]), marks).collect()
    assert len(found) == 600 and {r["good_lost"] for r in found} == {0}


def test_audit_of_more_parts_than_the_row_limit_allows(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "1000")
    try:
        found = filter_audit.filter_audit(docs_of(spark, [(i, "$", f"l{i}") for i in range(5)]), spark.createDataFrame([], LABELS))
        assert found.count() == 5 * 600
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000"
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before)


def features_by_hand(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def sample_by_hand(docs, target, n, buckets, min_words, percent, seed):
    def bucket(x):
        return zlib.crc32(x.encode()) % buckets

    raw = Counter(bucket(f) for _, t in docs for f in features_by_hand(t, n)[1])
    want = Counter(bucket(f) for t in target for f in features_by_hand(t, n)[1])
    s, t = sum(raw.values()), sum(want.values())
    scored = []
    for i, text in docs:
        count, features = features_by_hand(text, n)
        weight = sum(math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in map(bucket, features))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), count))
    able = sorted((x for x in scored if x[4] >= min_words), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = len(able) * percent // 100
    ranked = [x[:4] + (k if k <= drawn else None,) for k, x in enumerate(able, 1)]
    return sorted(ranked + [x[:4] + (None,) for x in scored if x[4] < min_words], key=repr)


@pytest.mark.parametrize("n", [1, 3])
def test_resampling_by_hand(spark, n):
    rng = random.Random(5)
    docs = ODD + [(i, " ".join(rng.choice(["Ana", "bé", "c-d", "x9", "ß ß", "E"]) for _ in range(rng.randint(0, 40)))) for i in range(10, 300)]
    docs += [(500, "very LONG " * 50_000), (10, docs[-1][1])]
    target = ["Ana bé", None, "", "x9 x9 c-d"]
    found = resampling.importance_resample(
        docs_of(spark, docs), spark.createDataFrame([(t, 1) for t in target], "text string, id long"), max_gram=n, buckets=97, min_words=5, percent=30, seed=3
    )
    assert found.columns == ["id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == sample_by_hand(docs, target, n, 97, 5, 30, 3)


def test_resampling_of_empty_tables(spark):
    none = docs_of(spark, [])
    some = docs_of(spark, [(1, "a " * 30), (2, None)])
    assert resampling.importance_resample(none, some).count() == 0
    found = {r["id"]: r for r in resampling.importance_resample(some, none, percent=100).collect()}
    assert found[1]["rank"] == 1 and found[2]["rank"] is None and found[2]["weight"] == 0


def test_resampling_counters_are_folded_when_full(spark, monkeypatch):
    docs = documents(spark).limit(50)
    whole = resampling.bucket_counts(docs, max_gram=2, buckets=101)
    held = Counter()
    for row in docs.collect():
        for f in features_by_hand(row["text"], 2)[1]:
            held[zlib.crc32(f.encode()) % 101] += 1
    assert whole == [held[i] for i in range(101)]
    monkeypatch.setattr(resampling, "MAX_HELD", 3)
    seeds = resampling._Seeds()
    assert [x for found in resampling.levels([b"a", b"b", b"c", b"d", b"a"], 2, seeds) for x in found] == [
        zlib.crc32(x) for x in (b"a", b"b", b"c", b"d", b"a", b"a b", b"b c", b"c d", b"d a")
    ]


def fingerprint_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_by_hand(prints):
    """(id, fingerprint) to (id, fingerprint, component) by all pairs."""
    around, root = defaultdict(set), {}
    different = sorted(set(f for _, f in prints))
    for a, b in itertools.combinations(different, 2):
        if (a ^ b).bit_count() <= 4:
            around[a].add(b)
            around[b].add(a)
    for start in different:
        if start not in root:
            queue = [start]
            while queue:
                x = queue.pop()
                if x not in root:
                    root[x] = start
                    queue += around[x]
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f, least.get(root[f])) for i, f in prints), key=repr)


def unsigned(rows):
    return sorted(((i, f % (1 << 64), c) for i, f, c in map(tuple, rows)), key=repr)


def test_simhash_query_by_hand(spark):
    prints = [(r["doc_id"], fingerprint_by_hand(r["text"])) for r in documents(spark).collect()]
    found = QUERIES["op13_simhash_near_dedup"](spark, SF)
    assert dict(found.dtypes) == {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(((i, f"{f:016x}", c) for i, f, c in classes_by_hand(prints)), key=repr)


def test_simhash_of_odd_rows_by_hand(spark):
    words = [f"w{i}" for i in range(120)]
    docs = ODD + [(20, " ".join(words)), (19, " ".join(words[:-1] + ["other"])), (None, " ".join(words)), (21, "A  b C\x0bd e"), (22, "one Two"), (23, "one two"),
                  (24, "long text here again " * 40_000), (20, "x"), (None, "lonely")]
    found = simhash.simhash_classes(docs_of(spark, docs)).select("id", "fingerprint", "component_id").collect()
    assert unsigned(found) == classes_by_hand([(i, fingerprint_by_hand(t)) for i, t in docs])
    assert simhash.simhash_classes(docs_of(spark, [])).count() == 0


def near(rng, base, flips):
    for bit in rng.sample(range(64), flips):
        base ^= 1 << bit
    return base


def test_linking_fingerprints_always_share_a_cell():
    rng = random.Random(2)
    for _ in range(300):
        a = rng.choice([0, (1 << 64) - 1, rng.getrandbits(64)])
        b = near(rng, a, rng.randint(1, 4))
        rows, cells = simhash.grid_cells(np.array([a, b], np.uint64))
        assert set(cells[rows == 0]) & set(cells[rows == 1])
        counts = simhash.segment_counts(np.array([a, b], np.uint64))
        assert np.abs(counts[0] - counts[1]).sum() <= (a ^ b).bit_count()
        assert counts[0].tolist() == [(a >> i & 1) + (a >> i + 1 & 1) for i in range(0, 64, 2)]


@pytest.mark.parametrize(("few", "block"), [(12, 2048), (3, 8)])
def test_crowded_cells_lose_no_connection(spark, monkeypatch, few, block):
    monkeypatch.setattr(simhash, "FEW", few)
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {near(rng, centre, rng.randint(0, 7)) for _ in range(150)} | {rng.getrandbits(64) for _ in range(100)}
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in prints], "fingerprint long")
    links = [(u % (1 << 64), v % (1 << 64)) for u, v in simhash.fingerprint_links(nodes).collect()]
    assert all(0 < (u ^ v).bit_count() <= 4 for u, v in links)
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        root[find(u)] = find(v)
    by_hand = classes_by_hand([(f, f) for f in prints])
    assert len({find(f) for f in prints}) == len({c for _, _, c in by_hand})
    for a, _, c in by_hand:
        assert find(a) == find(c)
