"""Near-duplicates and decontamination against brute force."""

import random
import re

import numpy as np
import pytest

from llm_small import AWKWARD, SF_DIR, sentence
from larder.llm import decontaminate, neardup, queries


def word_set(text, k):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute_components(texts, k, percent=80):
    """Smallest reachable id of every id; texts: id -> list of texts."""
    sets = [(d, word_set(t, k)) for d, ts in texts.items() for t in ts]
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in texts}


def check(rows, texts, k):
    want = brute_components(texts, k)
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_query_on_whole_table(spark, texts):
    rows = queries.op7_minhash_near_dedup(spark, SF_DIR).collect()
    check(rows, {d: [t] for d, t in texts.items()}, 2)
    assert {r.doc_id: r.n_shingles for r in rows} == {d: len(word_set(t, 2)) for d, t in texts.items()}


def variants(seed, n, base=60, swaps=4):
    """Texts around one base text, many of them near the threshold to each other."""
    r = random.Random(seed)
    words = sentence(seed, base).split()
    for _ in range(n):
        copy = list(words)
        for _ in range(r.randint(0, swaps)):
            copy[r.randrange(len(copy))] = sentence(r.random(), 1)
        yield " ".join(copy)


def test_group_of_variants_around_the_threshold(spark):
    texts = {i: [t] for i, t in enumerate([*variants(1, 250, swaps=9), *variants(2, 40), *variants(3, 40, 12, 1)])}
    docs = spark.createDataFrame([(d, t[0]) for d, t in texts.items()], "doc_id bigint, text string")
    check(neardup.near_duplicates(docs, words=2).collect(), texts, 2)


def test_awkward_documents(awkward, nothing):
    rows = neardup.near_duplicates(awkward, words=2).collect()
    assert len(rows) == len(AWKWARD)
    texts = {}
    for d, t in AWKWARD:
        texts.setdefault(-2 ** 63 if d is None else d, []).append(t)
    want = brute_components(texts, 2)
    name = lambda d: -2 ** 63 if d is None else d
    assert {name(r.doc_id): name(r.component_id) for r in rows} == want
    assert {r.n_shingles for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert neardup.near_duplicates(nothing).collect() == []
    left = neardup.keep(awkward, words=2)
    assert left.columns == awkward.columns
    assert sorted(r.doc_id for r in left.where("doc_id IS NOT NULL").collect()) == sorted(
        d for d, root in want.items() if d == root and d != -2 ** 63)
    assert neardup.keep(nothing).collect() == []


def test_an_id_with_two_texts_links_their_classes(spark):
    a, b = sentence(1, 30), sentence(2, 30)
    docs = spark.createDataFrame([(5, a), (7, a), (7, b), (9, b), (11, sentence(3, 30))], "doc_id bigint, text string")
    rows = neardup.near_duplicates(docs).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(5, 5), (7, 5), (9, 5), (11, 11)}


def test_rows_of_one_id_remove_each_other_only_if_alike(spark):
    a, b, c = (sentence(k, 30) for k in (1, 2, 3))
    rows = [(5, a), (5, b), (5, b), (7, a), (8, c), (None, c), (None, b), (None, sentence(4, 30)), (None, sentence(4, 30)),
            (None, None), (None, None), (9, None), (9, ""), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = sorted(map(tuple, neardup.keep(docs).collect()), key=repr)
    assert left == sorted([(5, a), (5, b), (8, c), (None, sentence(4, 30)), (None, None), (9, None), (9, "")], key=repr)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 200), (200, 200)]
    found = neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    got = {r.node: r.root for r in found}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[100 + i] == 100 for i in range(1, 30))
    assert got[300] == 200


@pytest.mark.parametrize("n", [1, 2, 5, 50, 3000])
def test_sketch_is_full_and_close(n):
    rng = np.random.default_rng(n)
    both, a, b = (rng.integers(0, 2 ** 63, k, np.uint64) for k in (4 * n, n, n))
    x, y = (neardup.sketch(np.unique(np.concatenate([both, part])), 512) for part in (a, b))
    assert (x != np.iinfo(np.uint64).max).all()
    assert abs((x == y).mean() - 4 / 6) < 0.15
    assert (neardup.sketch(np.unique(both), 512) == neardup.sketch(np.unique(both), 512)).all()


def brute_overlaps(text, item):
    """Is there a window of 12 words with at most two substitutions, or the whole shorter item with one from 6 words on?"""
    x, y = ([w.lower() for w in re.findall(r"\w+", t)] for t in (text, item))
    n = min(12, len(y))
    if not n or len(x) < n:
        return False
    x, y = np.array(x), np.array(y)
    for q in range(len(y) - n + 1):
        same = sum((x[k:len(x) - n + 1 + k] == y[q + k]).astype(int) for k in range(n))
        if same.max() >= (n - 2 if n == 12 else n - 1 if n >= 6 else n):
            return True
    return False


def test_decontamination_query(spark, texts):
    from larder.llm.common import table

    items = {r.item_id: r.text for r in table(spark, SF_DIR, "benchmark").collect()}
    rows = queries.op2_decontamination(spark, SF_DIR).collect()
    want = {(d, i) for d, t in texts.items() for i, s in items.items() if brute_overlaps(t, s)}
    assert {(r.doc_id, r.item_id) for r in rows} == want and want


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, sentence(50, 30)), (2, sentence(51, 8)), (3, "only four words here"), (4, None), (5, "!?"), (None, sentence(53, 20)), (1, sentence(50, 30))]
    return spark.createDataFrame(items, "item_id bigint, text string")


def planted():
    item = sentence(50, 30).split()
    around = sentence(60, 50).split()
    r = random.Random(5)
    out = {}
    for k in range(40):  # 12 words of the item, up to three of them substituted
        a, swaps = r.randrange(19), k % 4
        part = item[a:a + 12]
        for p in r.sample(range(12), swaps):
            part[p] = "zz"
        out[100 + k] = " ".join(around[:k] + part + around[k:])
    out[1] = "Before. " + sentence(51, 8).upper() + "!"
    out[2] = " ".join(sentence(51, 8).split()[:7])
    out[3] = "It has " + sentence(51, 8).replace(sentence(51, 8).split()[3], "zz")   # one word of a short item changed
    out[4] = sentence(51, 8).replace(sentence(51, 8).split()[3], "zz").replace(sentence(51, 8).split()[6], "zz")
    out[5] = "So only four words here are left"
    out[6] = "only four other words here"
    return out


@pytest.mark.parametrize("block_words", [10, 100_000])
def test_substituted_passages(spark, benchmark, awkward, block_words):
    texts = planted()
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    items = {1: sentence(50, 30), 2: sentence(51, 8), 3: "only four words here"}
    rows = decontaminate.overlaps(docs, benchmark, block_words).collect()
    want = {(d, i) for d, t in texts.items() for i, s in items.items() if brute_overlaps(t, s)}
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert {d for d, _ in want} >= {100 + k for k in range(40) if k % 4 <= 2} | {1, 3, 5}
    assert not {d for d, _ in want} & {2, 4, 6}
    at = next(r for r in rows if r.doc_id == 1)
    assert texts[1][at.start:at.end] == sentence(51, 8).upper()
    left = decontaminate.keep(docs, benchmark, block_words)
    assert {r.doc_id for r in left.collect()} == set(texts) - {d for d, _ in want}


def test_awkward_documents_are_clean(awkward, nothing, benchmark):
    assert decontaminate.overlaps(awkward, benchmark).collect() == []
    kept = decontaminate.keep(awkward, benchmark)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD)
    assert decontaminate.keep(nothing, benchmark).collect() == []
    assert decontaminate.keep(awkward, benchmark.where("false")).count() == len(AWKWARD)


def test_texts_and_items_that_repeat_themselves():
    import time

    block = decontaminate.Block([(1, "the " * 200), (2, "a b " * 300 + sentence(1, 20)), (3, "so so")])
    started = time.perf_counter()
    assert block.overlaps("the " * 20_000) == {0: (20_000 - 11, 0, 20_000)}
    assert block.overlaps("so " * 20_000) == {2: (19_999, 0, 20_000)}
    found = block.overlaps("b a " * 10_000 + "x " * 20 + sentence(1, 20))
    assert set(found) == {1} and found[1][2] == 20_040
    assert time.perf_counter() - started < 1


def test_many_windows_alike_but_for_ignored_words():
    """Each window of the text meets each of the item under some mask: every pair is compared once, many at a time."""
    import time

    r = random.Random(1)
    mixed = lambda n, p, words: [r.choice(words) if r.random() < p else "the" for _ in range(n)]
    item = mixed(400, 0.5, ["u", "v", "w"])
    block = decontaminate.Block([(1, " ".join(item))])
    text = " ".join(mixed(20_000, 0.5, ["x", "y", "z"]) + item[100:112])
    started = time.perf_counter()
    found = block.overlaps(text)
    assert time.perf_counter() - started < 5
    x, y = np.array(text.split()), np.array(item)
    same = [max(int((x[p:p + 12] == y[q:q + 12]).sum()) for q in range(len(y) - 11)) for p in range(len(x) - 600, len(x) - 11)]
    assert max(same) == 12 and found[0][2] == len(x)


def test_spans_stand_in_the_text_itself(spark, benchmark):
    text = "İ" * 3 + "! " + "İİ " * 10 + sentence(50, 30) + " end"
    row = decontaminate.overlaps(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), benchmark).first()
    assert text[row.start:row.end] == sentence(50, 30)
