"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from llm_small import AWKWARD, SF_DIR, sentence
from larder.llm import queries, simhash


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest reachable id of each id; prints: list of (id, fingerprint)."""
    root = {d: d for d, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if (x ^ y).bit_count() <= 3 or a == b:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in root}


def test_query_on_whole_table(spark, texts):
    rows = queries.op13_simhash_near_dedup(spark, SF_DIR).collect()
    prints = {d: brute_fingerprint(t) for d, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == brute_components(list(prints.items()))
    assert len(rows) == len(texts)


def test_awkward_documents(awkward, nothing):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    name = lambda d: -2 ** 63 if d is None else d
    want = brute_components([(name(d), brute_fingerprint(t)) for d, t in AWKWARD])
    assert {name(r.doc_id): name(r.component_id) for r in rows} == want
    assert {r.fingerprint for r in rows if r.doc_id in (3, 4, 5)} == {"0" * 16}
    assert simhash.near_duplicates(nothing).collect() == []


def flipped(seed, n, most, bits=range(64)):
    """Fingerprints around one, many near the limit to each other."""
    r = random.Random(seed)
    base = r.getrandbits(64)
    for _ in range(n):
        x = base
        for b in r.sample(list(bits), r.randint(0, most)):
            x ^= 1 << b
        yield x


@pytest.mark.parametrize("crowded", [0, 3, 40, 1024])
def test_links_join_what_brute_force_joins(spark, crowded, monkeypatch):
    r = random.Random(9)
    prints = {*flipped(1, 150, 5), *flipped(2, 60, 9, range(24)), *(r.getrandbits(64) for _ in range(100)), 0, 7, 2 ** 64 - 1}
    signed = [p - 2 ** 64 if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print bigint")
    found = [(x.a, x.b) for x in simhash.links(df, crowded).collect()]
    got = {x.node: x.root for x in simhash.components(spark.createDataFrame(found, "a bigint, b bigint")).collect()}
    want = brute_components([(s, s & 2 ** 64 - 1) for s in signed])
    assert {p: got.get(p, p) for p in signed} == want


@pytest.mark.parametrize("seed", range(4))
def test_bitmap_neighbours_join_what_the_tally_joins(seed):
    values = np.unique(np.random.default_rng(seed).integers(0, 1 << 24, 3000) & (0xFFFFFF if seed % 2 else 0xFF0F3))
    x = values.astype(np.uint64)
    linked = simhash.tally(*np.broadcast_arrays(x[:, None], x[None, :]))
    assert (simhash._neighbours(values) == simhash._tree(linked)).all()


def test_every_pair_of_near_fingerprints_shares_a_list():
    for bits in [(0, 8, 16), (63, 31, 7), (40, 41, 50), (1, 33, 60)]:
        other = sum(1 << b for b in bits)
        assert any(not other & simhash._mask(c) for c in simhash.THREES)


def test_a_crowded_list_grows_with_its_members():
    """A family in one list of five positions is joined through its bitmap, not pair by pair."""
    values = np.random.default_rng(1).permutation(1 << 16)[:20_000]
    assert len(set(simhash._neighbours(values))) == 1


def test_very_long_texts():
    text = sentence(1, 200) * 400
    words = text.split()
    assert len(words) > 70_000
    counts = [0] * 64
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(len(words) - 2)]
    for b in range(64):
        counts[b] = sum(h >> b & 1 for h in hashes)
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * counts[b] > len(hashes))
