"""The Merkle manifest against a plain walk over the table."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_small import AWKWARD, SF_DIR
from larder.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    """(doc_id, leaf, subroot, root, siblings, folded) of rows (grp, doc_id, leaf, claimed), sorted."""
    def level_up(nodes):
        return [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]

    def path(nodes, i):
        out = []
        while len(nodes) > 1:
            pair = nodes[i - i % 2:i - i % 2 + 2]
            out.append((i % 2, [x for k, x in enumerate(pair) if k != i % 2]))
            nodes, i = level_up(nodes), i // 2
        return out, nodes[0]

    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(row[0], []).append(row)
    subroots = [path([r[2] for r in g], 0)[1] for g in groups.values()]
    out = []
    for k, g in enumerate(groups.values()):
        upper, root = path(subroots, k)
        for i, (_, doc, leaf, claimed) in enumerate(g):
            own, subroot = path([r[2] for r in g], i)
            end = claimed or leaf
            for right, others in own + upper:
                end = h(*others, end) if right else h(end, *others)
            out.append((doc, leaf, subroot, root, [x for _, o in own + upper for x in o], end))
    return sorted(out, key=repr)


def found(df):
    rows = df.collect()
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [s[1:] for s in r.path if s != "-"], r.folded_root)
                   for r in rows), key=repr)


def test_query_on_whole_table(spark, documents):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    rows = []
    for r in documents.collect():
        leaf = h(*map(part, (r.doc_id, r.source, r.lang, r.n_chars, r.text)))
        hit = zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        rows.append((r.lang, r.doc_id, leaf, h(*map(part, (r.doc_id, r.source, r.lang, r.n_chars + 1, r.text))) if hit else None))
    want = sorted(((d, leaf, sub, root, h(*sib), end, end == root) for d, leaf, sub, root, sib, end in plain(rows)), key=repr)
    got = sorted(map(tuple, queries.op11_merkle_manifest(spark, SF_DIR).collect()), key=repr)
    assert got == want and 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("seed", range(3))
def test_groups_of_many_sizes_ties_and_missing_ids(spark, seed):
    r = random.Random(seed)
    rows = []
    for grp, n in [(None, 1), ("a", 2), ("b", 3), ("Z", 1025 + seed), ("é", 2050), ("c", 5)][seed:]:
        for _ in range(n):
            doc = r.choice([None, -5, 7, r.randrange(-2 ** 63, 2 ** 63), r.randrange(5000), r.randrange(5000)])
            rows.append((grp, doc, h(str(r.randrange(n))), r.choice([None, None, h("x")])))
    df = spark.createDataFrame(rows, "grp string, doc_id bigint, leaf string, claimed string")
    # rows alike but for their claim may stand in either order, so claims of such rows are left out
    alike = {k for k in ((g, d, leaf) for g, d, leaf, _ in rows) if sum(x[:3] == k for x in rows) > 1} if seed else set()
    if alike:
        rows = [(g, d, leaf, None if (g, d, leaf) in alike else c) for g, d, leaf, c in rows]
        df = spark.createDataFrame(rows, df.schema)
    else:
        rows = [(*x[:3], None) for x in rows]
        df = df.withColumn("claimed", F.lit(None).cast("string"))
    assert found(merkle.manifest(df)) == plain(rows)


def test_three_rounds_of_arrays(spark):
    rows = [(g, i, h(g, str(i)), None) for g, n in (("a", 70), ("b", 17), ("c", 4), ("d", 1), ("e", 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "grp string, doc_id bigint, leaf string, claimed string")
    assert found(merkle.manifest(df, slot_bits=2)) == plain(rows)


def test_awkward_documents(awkward, nothing):
    rows = lambda d: d.select(F.col("kept").alias("grp"), "doc_id", merkle.hashed(F.col("doc_id"), F.col("text")).alias("leaf"),
                              F.lit(None).cast("string").alias("claimed"), "score", "root", "n")
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    assert found(merkle.manifest(rows(awkward))) == plain([("extra", d, h(part(d), part(t)), None) for d, t in AWKWARD])
    assert merkle.manifest(rows(nothing)).collect() == []
    one = merkle.manifest(rows(awkward.where("doc_id = 2"))).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.path == []


@pytest.mark.parametrize("n", [1, 3, 200, 4096])
def test_ranks_count_rows_below(n):
    rng = np.random.default_rng(n)
    low = np.sort(rng.choice(4096, n, replace=False))
    counts = rng.choice([1, 1, 1, 4], n)
    parts = merkle.packed(low, counts)
    assert (merkle.unpacked(*parts)[low] == counts).all() and merkle.unpacked(*parts).sum() == counts.sum()
    want = np.concatenate([[0], np.cumsum(merkle.unpacked(*parts))])
    ranks = merkle.Ranks(*parts)
    assert (ranks.below(np.arange(4096)) == want[:4096]).all()
    assert (ranks.tied(low) == (counts > 1)).all()
