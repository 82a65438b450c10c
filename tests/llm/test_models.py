"""Language, quality models and rules: held-out accuracy, constraints, counts by brute force."""

import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import langid, quality_model, quality_rules, queries, textstats
from larder.llm.common import table
from llm_small import AWKWARD, SF_DIR

SF_MORE = "/root/testdata/sf0.01"


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def brute_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ß", " ", "  ", "\n", "\t", "#", "x y z v w\n", "|", "\x0b", " ", "\x1c"]),
                max_size=60).map("".join))
def test_counts(text):
    assert textstats.statistics(text)[0] == brute_counts(text)


def test_rules_query(spark, texts):
    rows = queries.op9_quality_rules(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_counts(texts[r.doc_id])
        assert [r[c] for c in textstats.COUNTS] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_rules_reject_bad_and_keep_good(spark):
    label = {r.doc_id: r.quality for r in table(spark, SF_MORE, "labels").collect()}
    rows = [r for r in queries.op9_quality_rules(spark, SF_MORE).collect() if r.doc_id in label and not r.base_failed]
    good = [r.kept for r in rows if label[r.doc_id] == 1]
    bad = [r.kept for r in rows if label[r.doc_id] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_awkward_documents(spark, awkward, nothing):
    rows = quality_rules.assess(awkward, None).collect()
    assert sorted(((r.doc_id, *[r[c] for c in textstats.COUNTS]) for r in rows), key=repr) == sorted(
        ((d, *brute_counts(t)) for d, t in AWKWARD), key=repr)
    kept = quality_rules.keep(awkward, None)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(r.kept for r in rows)
    assert quality_rules.assess(nothing, None).collect() == [] == quality_rules.keep(nothing, None).collect()
    none = spark.createDataFrame([], "doc_id bigint, label int")
    assert quality_rules.fit(awkward, none) is None
    model = quality_model.fit(awkward, none)
    assert {r.score for r in quality_model.score(awkward, model).collect()} == {0.5}
    assert quality_model.score(nothing, model).collect() == []
    one = spark.createDataFrame([(1, 1), (8, 1), (None, 0), (10, None)], "doc_id bigint, label int")
    assert all(r.predicted == 1 for r in quality_model.score(awkward, quality_model.fit(awkward, one)).collect())
    assert all(0 <= r.score <= 1 for r in quality_rules.assess(awkward, quality_rules.fit(awkward, one)).collect())


def noisy(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4))
    y = (x[:, 0] + 0.5 * np.sin(9 * x[:, 1]) - x[:, 2] + 2 * (x[:, 0] > 0.5) * (x[:, 3] > 0.5) + rng.normal(0, 0.3, n)) > 0.6
    return x, y.astype(float)


def test_constrained_trees_never_rise():
    x, y = noisy(4000, 1)
    forest = quality_rules.fit_forest(x, y, [1, 0, -1, 0])
    test, truth = noisy(2000, 2)
    assert ((forest.score(test) > 0.5) == truth).mean() > 0.85
    for f, sign in ((0, 1), (2, -1)):
        grid = np.repeat(test[:100], 50, axis=0)
        grid[:, f] = np.tile(np.linspace(0, 1, 50), 100)
        steps = np.diff(forest.score(grid).reshape(100, 50), axis=1) * sign
        assert (steps >= -1e-12).all()


def test_flat_nodes_equal_a_walk():
    x, y = noisy(500, 3)
    forest = quality_rules.fit_forest(x, y, [0, 0, 0, 0])
    for row, got in zip(x[:50], forest.score(x[:50])):
        total = forest.start
        for at in forest.roots:
            while forest.left[at] != at:
                at = forest.left[at] if row[forest.feature[at]] <= forest.limit[at] else forest.right[at]
            total += forest.value[at]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_additive_model_learns_shapes_and_pairs():
    (x, y), (test, truth) = noisy(4000, 4), noisy(2000, 5)
    model = quality_model.fit_additive(x, y)
    assert ((model.score(test) > 0.5) == truth).mean() > 0.85
    assert (0, 3) in model.pairs[:2]
    alone = quality_model.Additive(model.edges, model.coarse, model.start, model.tables)
    assert not np.allclose(alone.score(test), model.score(test))


def test_classifier_query_on_held_out(spark):
    label = {r.doc_id: r.quality for r in table(spark, SF_MORE, "labels").collect()}
    rows = queries.op8_quality_classifier(spark, SF_MORE).collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.95


def test_language_query_on_held_out(spark):
    lang = {r.doc_id: r.lang for r in table(spark, SF_MORE, "documents").select("doc_id", "lang").collect()}
    rows = queries.op3_language_id(spark, SF_MORE).collect()
    assert len(rows) == len(lang) and all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.95


def test_language_of_awkward_documents(spark, awkward, nothing):
    from pyspark.sql import functions as F

    training = awkward.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") < 9, "bb"))
    model = langid.fit(training)
    rows = {r.doc_id: r for r in langid.identify(awkward, model).collect()}
    assert all(rows[d].lang_pred == "und" and rows[d].score == 0 for d in (3, 4, 5))
    assert {r.lang_pred for r in rows.values()} <= {"aa", "bb", "und"}
    assert langid.identify(nothing, model).collect() == []
    unlearned = langid.fit(training.where("false"))
    assert {r.lang_pred for r in langid.identify(awkward, unlearned).collect()} == {"und"}


def test_weights_are_sparse_and_calibrated():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600)
    rows = [(np.sort(rng.choice(200, 20, False)) + 200 * k, np.full(20, 20 ** -0.5)) for k in y]
    weights = langid.ftrl(rows, y, 2)
    assert (weights[400:] == 0).all() and (np.abs(weights[:400]).sum(axis=1) > 0).mean() > 0.9
    # logits that are four times too sure
    p = rng.uniform(0.05, 0.95, 4000)
    logits = 4 * np.stack([np.log(p), np.log(1 - p)], axis=1)
    assert langid.temperature(logits, (rng.random(4000) > p).astype(int)) == pytest.approx(4, rel=0.2)


def slow_language(text, model):
    """A prediction letter by letter: n-grams in a dictionary, one product a language."""
    full = 2 ** 32 - 1
    a, b, c = 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D
    letters = [32]
    for ch in text:
        low = (ord(ch.lower()[0]) if ord(ch) < 65536 else ord(ch)) if ch.isalpha() else 32
        if not (low == 32 and letters[-1] == 32):
            letters.append(low)
    letters += [32] if letters[-1] != 32 else []
    counts = {}
    for i, x in enumerate(letters):
        hashes = [x * a]
        if i + 1 < len(letters):
            hashes.append((x * b) & full ^ (letters[i + 1] * c + a) & full)
        if i + 2 < len(letters):
            hashes.append((hashes[1] * a) & full ^ (letters[i + 2] * b + c) & full)
        for h in hashes:
            h &= full
            k = ((h ^ h >> 15) * c & full) >> 16
            counts[k] = counts.get(k, 0) + 1
    values = {k: (1 + np.log(n)) * float(model.idf[k]) for k, n in counts.items()}
    size = sum(v * v for v in values.values()) ** 0.5
    logits = [sum(v / size * float(model.weights[k, j]) for k, v in values.items()) / model.temperature
              for j in range(len(model.langs))]
    odds = [np.exp(x - max(logits)) for x in logits]
    best = max(range(len(odds)), key=lambda j: odds[j])
    return model.langs[best], odds[best] / sum(odds)


def test_language_scores_against_a_slow_walk(spark, documents):
    model = langid.fit(documents.select("doc_id", "text", "lang"))
    rows = {r.doc_id: r for r in langid.identify(documents, model).collect()}
    for r in documents.limit(25).collect():
        lang, score = slow_language(r.text, model) if any(ch.isalpha() for ch in r.text or "") else ("und", 0.0)
        assert rows[r.doc_id].lang_pred == lang and rows[r.doc_id].score == pytest.approx(score, abs=1e-5)


def test_quality_scores_against_a_slow_walk(spark, documents):
    from larder.llm.queries import quality_labels

    model = quality_model.fit(documents, quality_labels(spark, SF_DIR))
    rows = {r.doc_id: r for r in quality_model.score(documents, model).collect()}
    for r in documents.limit(60).collect():
        x = textstats.matrix([r.text])[1][0]
        margin = model.start
        for f, edges in enumerate(model.edges):
            margin += model.tables[f][sum(e < x[f] for e in edges)]
        for (a, b), grid in zip(model.pairs, model.grids):
            margin += grid[sum(e < x[a] for e in model.coarse[a])][sum(e < x[b] for e in model.coarse[b])]
        score = 1 / (1 + np.exp(-margin))
        assert rows[r.doc_id].score == pytest.approx(score) and rows[r.doc_id].predicted == int(score >= 0.3)
