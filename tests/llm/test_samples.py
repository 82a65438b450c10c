"""Bounded samples: what reaches the driver, whatever repeats in the table."""

from pyspark.sql import functions as F

from llm_small import sentence
from larder.llm import common, langid, queries, tokenfiles


def test_a_repeated_id_brings_one_text(spark):
    rows = [(7, sentence(1, 10 + k % 3), "aa") for k in range(300)] + [(k, sentence(k, 10), "bb") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    ids = docs.select("doc_id", "lang").distinct()
    got = common.with_sampled_text(docs, common.sample_ids(ids, 50, "lang")).collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 2, 7]
    assert [r.text for r in got if r.doc_id == 7] == [min(t for d, t, _ in rows if d == 7)]
    model = langid.fit(docs)
    assert model.langs == ["aa", "bb"]


def test_the_sample_is_the_first_in_hash_order(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    want = [r.doc_id for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(500).collect()]
    assert sorted(r.doc_id for r in common.sample_ids(rows, 500).collect()) == sorted(want)
    through = rows.where(common.in_sample(500, 20_000, F.col("doc_id"))).count()
    assert 500 <= through < 1000


def test_the_dictionary_takes_slices_from_any_place(spark):
    """The words of a long text's end, or of a row that repeats an id, are as likely to be in the sample."""
    long = " ".join(["start"] * 20_000 + ["middle"] * 20_000 + ["finish"] * 20_000)
    docs = spark.createDataFrame([(1, long)] * 40 + [(k, sentence(k, 50)) for k in range(50)], "doc_id bigint, text string")
    whole = tokenfiles.train(docs, queries.WORD_BPE, "word", 2)
    part = tokenfiles.train(docs, queries.WORD_BPE, "word", 2, sample_chars=400_000)
    assert part == tokenfiles.train(docs, queries.WORD_BPE, "word", 2, sample_chars=400_000) != whole
    finish = tokenfiles.encoder(queries.WORD_BPE, "word").tokenizer.encode("finish", add_special_tokens=False).ids
    assert all(i.to_bytes(2, "little") in part for i in finish)
    assert tokenfiles.train(docs.where("false"), queries.WORD_BPE, "word", 2) == b""
