"""Classifier, language model and language profiles: held-out accuracy, gradients, brute-force counts, odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from finlake.llm import languages as lang
from finlake.llm import lm_scoring, quality, recurrent
from finlake.llm.common import not_remainder
from finlake.llm.queries import QUERIES

from .helpers import ODD, SF, docs_of, documents


def test_quality_query_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in documents(spark, "labels").collect()}
    found = QUERIES["op1_quality_classifier"](spark, SF).collect()
    assert len(found) == 200
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    right = [r["predicted"] == labels[r["doc_id"]] for r in found if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert len(right) > 5 and np.mean(right) >= 0.8


def quality_by_hand(spark):
    """Scores of all documents by a plain loop over features, in double precision."""
    docs = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    marked = documents(spark, "labels").select("doc_id", "quality", F.xxhash64("doc_id").alias("h")).distinct().collect()
    chosen = [r for r in sorted(marked, key=lambda r: r["h"]) if r["quality"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    chosen = [r for r in chosen[:6000] if docs.get(r["doc_id"]) is not None]

    def features(text):
        words, out = text.encode().split(), Counter()
        for i, w in enumerate(words):
            out.update(quality.features_of(w))
            if i and w == words[i - 1]:
                out[quality.REPEAT] += 1
        return sorted(out.items())

    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / quality.DIM, 1 / quality.DIM, (quality.BUCKETS + 1, quality.DIM)).astype(np.float32).astype(np.float64)
    output, rows = np.zeros((quality.DIM, 2)), [(features(docs[r["doc_id"]]), r["quality"]) for r in chosen]
    rows = [r for r in rows if r[0]]
    bias = np.log([(sum(y == k for _, y in rows) + 1) / (len(rows) + 2) for k in (0, 1)])

    def forward(found):
        size = sum(n for _, n in found)
        hidden = sum(n / size * vectors[b] for b, n in found) if found else np.zeros(quality.DIM)
        odds = np.exp(hidden @ output + bias)
        return hidden, size, odds / odds.sum()

    step, steps = 0, quality.EPOCHS * len(rows)
    for _ in range(quality.EPOCHS):
        for i in rng.permutation(len(rows)):
            found, y = rows[i]
            hidden, size, odds = forward(found)
            error, rate = odds - np.eye(2)[y], quality.RATE * (1 - step / steps)
            back = output @ error
            output -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            for b, n in found:
                vectors[b] -= rate * len(found) ** 0.5 * n / size * back
            step += 1
    return {i: forward(features(t or ""))[2][1] for i, t in docs.items()}


def test_quality_query_by_hand(spark):
    expected = quality_by_hand(spark)
    found = {r["doc_id"]: r["score"] for r in QUERIES["op1_quality_classifier"](spark, SF).collect()}
    assert set(found) == set(expected) and max(abs(found[i] - expected[i]) for i in found) < 2e-3
    assert len({round(x, 2) for x in found.values()}) > 5


def test_packed_features_come_back():
    rng = np.random.default_rng(1)
    for total in (np.zeros(quality.BUCKETS + 1, np.int64), rng.integers(0, 2, quality.BUCKETS + 1), rng.poisson(0.001, quality.BUCKETS + 1) * 100_000):
        buckets, counts = quality.unpack_counts(quality.pack_counts(total))
        assert buckets.tolist() == np.flatnonzero(total).tolist() and counts.tolist() == total[total > 0].tolist()


def test_quality_rows_are_bounded_and_each_id_is_one(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda buckets, counts, cuts, labels, classes: seen.append((cuts.tolist(), labels, buckets.tolist())))
    docs = docs_of(spark, [(i, f"w{i} x") for i in range(20)] + [(3, "a text that is smaller"), (3, None), (None, "z"), (50, "")])
    marks = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, 0), (3, 1), (7, None), (None, 1), (50, 1), (99, 1)], "doc_id long, quality int")
    quality.fit(docs, marks, F.lit(True))
    sizes = np.diff(seen[0][0])
    assert len(sizes) == 22 and sorted(seen[0][1]) == [0] * 11 + [1] * 11 and min(sizes) == 0
    quality.fit(docs, marks, F.lit(True), max_features=int(sizes[:5].sum()) + 1)
    assert np.diff(seen[1][0])[:5].tolist() == sizes[:5].tolist() and 5 <= len(seen[1][1]) <= 6
    quality.fit(docs, marks, F.lit(True), max_rows=4)
    assert len(seen[2][1]) == 4


def test_quality_scores_are_the_softmax_of_the_average():
    rng = np.random.default_rng(3)
    model = quality.Model(rng.normal(size=(quality.BUCKETS + 1, 4)), rng.normal(size=(4, 2)), rng.normal(size=2))
    words = b"one two two three one one \xc3\xa9t\xc3\xa9".split()
    named = [b for w in words for b in quality.features_of(w)] + [quality.REPEAT] * 2
    logits = model.vectors[named].mean(axis=0) @ model.output + model.bias
    known = quality._Words(model.buckets())
    sums = known.sums(words)
    assert np.allclose(sums[:-1] / sums[-1] + model.bias, logits)


def test_quality_of_odd_rows_and_without_labels(spark):
    docs = docs_of(spark, [*ODD, (9, "w " * 70_000)])
    labels = spark.createDataFrame([(6, 1, 0), (4, 0, 0), (None, 1, 0), (9, None, 0), (77, 1, 0)], "doc_id long, quality int, text int")
    for rows in (labels, labels.limit(0)):
        model = quality.fit(docs, rows, F.lit(True))
        found = quality.quality_scores(docs, model).collect()
        assert len(found) == 8 and all(0 <= r["score"] <= 1 for r in found)
        same = [r["score"] for r in found if r["id"] == 6]
        assert same[0] == same[1]
    assert quality.quality_scores(docs.limit(0), model).count() == 0
    scored = quality.with_scores(docs, model, "text", "__score")
    assert scored.columns == docs.columns + ["__score"]


def small_model(seed=0, symbols=70, hidden=6):
    rng = np.random.default_rng(seed)
    model = recurrent.new_model(np.arange(symbols, 0, -1.0), hidden)
    return {k: (v + rng.normal(0, 0.2, v.shape)).astype(np.float32) for k, v in model.items()}, rng


def test_recurrent_gradients():
    model, rng = small_model()
    texts = [rng.integers(0, 70, int(n)).astype(np.int32) for n in rng.integers(1, 40, 9)]
    gradients = {}

    class Recorder(recurrent.Trainer):
        def _step(self, name, gradient, at=slice(None)):
            full = np.zeros_like(self.model[name])
            full[at] += gradient
            gradients[name] = full

    Recorder(model).learn(texts, 4, 1000)
    for name, gradient in gradients.items():
        at = np.unravel_index(np.argmax(np.abs(gradient)), gradient.shape)
        up, down = ({k: v.copy() for k, v in model.items()} for _ in range(2))
        up[name][at] += 0.01
        down[name][at] -= 0.01
        slope = -(recurrent.score(up, texts, 4).sum() - recurrent.score(down, texts, 4).sum()) / 0.02 / 4000
        assert slope == pytest.approx(gradient[at], rel=0.01), name


def test_recurrent_scores_are_distributions_and_ignore_lanes():
    model, rng = small_model(symbols=64)
    texts = [rng.integers(0, 64, int(n)).astype(np.int32) for n in (1, 7, 60, 33, 2, 0)]
    whole = recurrent.score(model, texts, 1, 1000)
    assert whole[5] == 0
    for lanes, window in ((2, 5), (6, 24), (3, 1)):
        assert np.allclose(recurrent.score(model, texts, lanes, window), whole, atol=1e-3)
    head = texts[1]
    total = sum(math.exp(s) for s in recurrent.score(model, [np.append(head, s).astype(np.int32) for s in range(64)]))
    assert math.log(total) == pytest.approx(recurrent.score(model, [head])[0], abs=1e-3)


def brute_base(rows, learn):
    words = [(t or "").encode().lower().split() + [b"\n"] for _, t in rows]
    counts = Counter(w for (i, _), own in zip(rows, words, strict=True) if learn(i) for w in own)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (len(own), sum(w in counts for w in own), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 6)) for own in words
    )


@pytest.mark.parametrize("head", [1 << 17, 40])
def test_lm_base_scores_against_brute_force(spark, head, monkeypatch):
    monkeypatch.setattr(lm_scoring.head_words, "__defaults__", (head,))
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = lm_scoring.lm_scores(docs, not_remainder(F.col("doc_id"), 10, 0)).collect()
    got = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found)
    assert got == brute_base(rows, lambda i: zlib.crc32(str(i).encode()) % 10 != 0)
    # The model knows more than the counts.
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)


def test_lm_odd_rows(spark):
    docs = docs_of(spark, [*ODD, (9, "long " * 30_000 + "x" * 5000)])
    for learn, known in ((F.lit(True), True), (F.lit(False), False)):
        found = lm_scoring.lm_scores(docs, learn).collect()
        assert len(found) == 8 and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in found)
        assert all((r["n_known"] == r["n_tokens"]) == known for r in found)
    assert lm_scoring.lm_scores(docs.limit(0), F.lit(True)).count() == 0


def test_head_words_takes_whole_levels(spark):
    counts = spark.createDataFrame([("a", 9), ("b", 9), ("c", 2), ("d", 1), ("x" * 65, 50), ("\n", 70)], "word string, c long")
    assert lm_scoring.head_words(counts, 3) == {b"a": 9, b"b": 9, b"c": 2}
    assert lm_scoring.head_words(counts, 1) == {}


def test_language_query_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["lang"] for r in documents(spark).collect()}
    found = QUERIES["op6_language_id"](spark, SF).collect()
    assert len(found) == 200
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_profiles_and_distance_by_hand(spark):
    docs = docs_of(spark, [(1, "ab ab", "x"), (2, "AB é", "x"), (3, "zz", "y"), (4, "q", None), (5, None, "y"), (6, "12 !", "z")])
    known = lang.profiles(docs, F.lit(True))
    counts = Counter(g for w in ("ab", "ab", "ab", "é") for g in lang.grams_of(w))
    assert known["x"] == sorted(counts, key=lambda g: (-counts[g], g)) and set(known) == {"x", "y"}
    rank = lang.make_ranker(known, 400)
    # Ties of frequency may rank otherwise in a document than in a profile.
    assert rank("zz")[0] == "y" and rank("zz")[1] > 0.98
    found = {r["doc_id"]: r for r in lang.languages(docs, known, keep=(F.col("doc_id"),)).collect()}
    assert (found[5]["lang_pred"], found[5]["score"], found[6]["lang_pred"]) == ("und", 0.0, "und")
    assert found[1]["lang_pred"] == "x" and found[3]["lang_pred"] == "y"
    assert lang.make_ranker({}, 400)("abc") == ("und", 0.0)
    assert lang.languages(docs.limit(0), known, keep=(F.col("doc_id"),)).count() == 0
    odd = lang.languages(docs_of(spark, [*ODD, (8, "la " * 200_000)]), known, keep=(F.col("doc_id"),)).collect()
    assert len(odd) == 8


def ranked_by_hand(text, known, size):
    """The nearest language by plain counting and plain sums."""
    words = regex.findall(r"\p{L}+", (text or "").lower())
    counts = Counter(g for w in words for n in (1, 2, 3) for g in lang_grams(w, n))
    order = sorted(counts, key=lambda g: (-counts[g], xxhash.xxh3_64_intdigest(g)))[:size]
    best = ("und", 0.0)
    if order and known:
        apart = {
            name: sum(abs(i - profile.index(g)) if g in profile else size for i, g in enumerate(order)) for name, profile in known.items()
        }
        name = min(sorted(apart), key=apart.get)
        best = (name, 1 - apart[name] / (size * len(order)))
    return best


def lang_grams(word, n):
    marked = word if n == 1 else f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def profiles_by_hand(rows, size):
    out = {}
    for name in sorted({x for _, x in rows if x}):
        counts = Counter(g for t, x in rows if x == name for w in regex.findall(r"\p{L}+", t.lower()) for n in (1, 2, 3) for g in lang_grams(w, n))
        if counts:
            out[name] = sorted(counts, key=lambda g: (-counts[g], g))[:size]
    return out


@pytest.mark.parametrize("block", [1000, 1])
def test_languages_by_hand(spark, monkeypatch, block):
    monkeypatch.setattr(lang, "BLOCK", block)
    docs = documents(spark).select("doc_id", "text", "lang")
    rows = [(r["text"], r["lang"]) for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    known = lang.profiles(docs, not_remainder(F.col("doc_id"), 3, 1))
    assert known == profiles_by_hand(rows, 400)
    found = lang.languages(docs, known, keep=(F.col("doc_id"), F.col("text"))).collect()
    assert len(found) == docs.count()
    for r in found:
        name, score = ranked_by_hand(r["text"], known, 400)
        assert r["lang_pred"] == name and abs(r["score"] - score) < 1e-12


def test_numerals_are_no_letters(spark):
    texts = ["\u00bd", "\u00b2 \u2460", "7 _ 8", "\u00bda", "\u0301", None, "", " \n"]
    docs = docs_of(spark, [(i, t) for i, t in enumerate(texts)] + [(99, "a b ab", "x"), (98, "\u00bd \u00b2", "y")])
    known = lang.profiles(docs.where("doc_id > 90"), F.lit(True))
    assert list(known) == ["x"]
    found = {r["doc_id"]: (r["lang_pred"], r["score"] > 0) for r in lang.languages(docs, known, keep=(F.col("doc_id"),)).collect()}
    assert [found[i] for i in range(len(texts))] == [("x", True) if t == "\u00bda" else ("und", False) for t in texts]


def test_ranker_forgets_without_changing_results(monkeypatch):
    known = {"x": ["a", "b", "ab"], "y": ["z", " z"]}
    texts = [f"{'ab' * (i % 3)} z{i} {chr(97 + i % 26)}" for i in range(60)]
    whole = [lang.make_ranker(known, 5)(t) for t in texts]
    monkeypatch.setattr(lang, "MAX_WORDS", 3)
    rank = lang.make_ranker(known, 5)
    assert [rank(t) for t in texts] == whole


def test_symbols_follow_the_number_of_words(spark, monkeypatch):
    sizes, new_model = [], recurrent.new_model

    def spied(counts, *more):
        model = new_model(counts, *more)
        sizes.append((len(counts), len(model["turn"])))
        return model

    monkeypatch.setattr(recurrent, "new_model", spied)
    docs = docs_of(spark, [(i, " ".join(f"w{j}" for j in range(i * 100, i * 100 + 200))) for i in range(40)])
    assert lm_scoring.lm_scores(docs, F.lit(True), rounds=1).count() == 40
    monkeypatch.setattr(lm_scoring, "WORDS_A_SYMBOL", 1)
    lm_scoring.lm_scores(docs, F.lit(True), rounds=1).count()
    assert sizes == [(2048, 16), (4101, 16)]


def test_classifier_learns_from_six_thousand_rows(spark, monkeypatch):
    seen, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda b, c, cuts, y, classes: seen.append(len(y)) or train(b, c, cuts[:11], y[:10], classes))
    docs = spark.range(6100).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    quality.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")), F.lit(True))
    assert seen == [6000]


def likely_by_hand(model, text):
    """One text, one symbol and one number at a time, in double precision."""
    hidden, size = len(model["turn"]), model["to_symbol"].shape[2]
    m = {k: v.astype(float) for k, v in model.items()}
    h, total = [0.0] * hidden, 0.0

    def log_share(logits, at):
        top = max(logits)
        return logits[at] - top - math.log(sum(math.exp(x - top) for x in logits))

    for symbol in map(int, text):
        c, k = divmod(symbol, size)
        total += log_share([sum(h[j] * m["to_class"][j, i] for j in range(hidden)) + m["class_bias"][i] for i in range(len(m["class_bias"]))], c)
        total += log_share([sum(h[j] * m["to_symbol"][c, j, i] for j in range(hidden)) + m["symbol_bias"][c, i] for i in range(size)], k)
        a = m["enter"][symbol] + m["start"]
        turned = [sum(h[j] * m["turn"][j, i] for j in range(hidden)) for i in range(3 * hidden)]
        gate = [1 / (1 + math.exp(-(a[i] + turned[i]))) for i in range(2 * hidden)]
        fresh = [math.tanh(a[2 * hidden + i] + gate[hidden + i] * turned[2 * hidden + i]) for i in range(hidden)]
        h = [gate[i] * h[i] + (1 - gate[i]) * fresh[i] for i in range(hidden)]
    return total


@pytest.mark.parametrize("symbols", [90, 5000])
def test_scores_by_a_plain_loop(symbols):
    rng = np.random.default_rng(3)
    model = recurrent.new_model(np.arange(symbols, 0, -1.0), 4)
    model = {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in model.items()}
    texts = [rng.integers(0, symbols, n).astype(np.int32) for n in (1, 2, 0, 30, 7)]
    found = recurrent.score(model, texts, 2, 5)
    assert found == pytest.approx([likely_by_hand(model, t) for t in texts], abs=2e-3)


def test_sixteen_thousand_symbols():
    symbols = lm_scoring.MOST_SYMBOLS
    assert [recurrent.class_size(n) for n in (10, 2048, 4101, symbols)] == [32, 32, 64, 128]
    model = recurrent.new_model(1e6 / np.arange(1, symbols + 1))
    assert model["to_symbol"].shape == (128, 16, 128) and model["enter"].shape == (symbols, 48)
    rng = np.random.default_rng(4)
    texts = [np.tile(rng.integers(0, symbols, 3), 40).astype(np.int32) for _ in range(200)]
    trainer = recurrent.Trainer(model)
    for _ in range(8):
        trainer.learn(texts)
    assert recurrent.score(trainer.model, texts).sum() > recurrent.score(model, texts).sum()
    head = texts[0][:5]
    total = sum(math.exp(s) for s in recurrent.score(trainer.model, [np.append(head, s).astype(np.int32) for s in range(symbols)]))
    assert math.log(total) == pytest.approx(recurrent.score(trainer.model, [head])[0], abs=2e-3)


def test_features_of_the_training_rows_take_little_of_the_driver(spark, monkeypatch):
    held = []
    monkeypatch.setattr(quality, "train", lambda b, c, cuts, y, classes: held.append((b.nbytes + c.nbytes, cuts[-1], len(y))))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.hex(i * 7919 + F.col("id")))).alias("text"))
    quality.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")), F.lit(True))
    (size, features, rows), = held
    assert rows == 40 and features > 20_000 and size < 3 * features


def test_model_copies_follow_the_tokens_not_the_partitions(spark, monkeypatch):
    copies, averaged = [], lm_scoring._averaged
    monkeypatch.setattr(lm_scoring, "_averaged", lambda df, *more: copies.append(df.select("part").distinct().count()) or averaged(df, *more))
    docs = docs_of(spark, [(i, f"a b c{i % 7} d") for i in range(200)]).repartition(23)
    assert lm_scoring.lm_scores(docs, F.lit(True)).count() == 200
    assert copies == [1, 1]
    monkeypatch.setattr(lm_scoring, "COPY_TOKENS", 200)  # 1000 tokens, 500 a round
    assert lm_scoring.lm_scores(docs, F.lit(True)).count() == 200
    assert copies[2:] == [3, 3]


def test_ranker_looks_for_words_only_in_runs_not_met_before(monkeypatch):
    texts = ["Σας ΟΔΟΣ, a", "½a “quoted”—dash x", "ǅ İstanbul a_b 9z९z", "\x1c a\x85b don't", "日本語、テスト 12", "", "_ 7"]
    expected = [Counter(re.findall(r"[^\W\d_]+", t.lower())) for t in texts]
    assert [Counter(w for r in lang.runs_of(t) for w in lang._WORD.findall(r.decode())) for t in texts] == expected
    rank = lang.make_ranker({"x": ["a", "s", "ab"], "y": ["z", " z"]}, 5)
    first = [rank(t) for t in texts]

    class Never:
        def findall(self, text):
            raise AssertionError(text)

    monkeypatch.setattr(lang, "_WORD", Never())
    assert [rank(t) for t in texts] == first
