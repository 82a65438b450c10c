"""The pipeline against its stages by brute force on a whole small table."""

import pytest

import corpus_pipeline
from larder.llm import decontaminate, neardup, quality_rules, queries, secrets
from larder.llm.common import table
from llm_small import AWKWARD, SF_DIR
from test_pairs import brute_components, brute_overlaps
from test_tokens import check_packed


def test_whole_table(spark, documents, texts):
    forest = quality_rules.fit(documents, queries.quality_labels(spark, SF_DIR))
    ids = sorted(texts)
    kept = quality_rules.verdicts([texts[d] for d in ids], forest)[3]
    left = {d: texts[d] for d, k in zip(ids, kept) if k}
    root = brute_components({d: [t] for d, t in left.items()}, neardup.WORDS)
    left = {d: t for d, t in left.items() if root[d] == d}
    items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
    left = {d: secrets.masked(t) for d, t in left.items() if not any(brute_overlaps(t, i) for i in items)}
    check_packed(corpus_pipeline.run(spark, SF_DIR).collect(), left.items(), queries.PACK_END)
    assert 0.3 * len(texts) < len(left) < len(texts)


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_awkward_documents(spark, awkward, empty):
    docs = awkward.where("false") if empty else awkward
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "best-fit packing":
            assert out.columns == docs.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert empty == (out.count() == 0)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near-duplicates", "decontamination", "secret scan", "best-fit packing"]
    assert corpus_pipeline.ORACLE_SQL is None and len(AWKWARD) and decontaminate.MASKS
