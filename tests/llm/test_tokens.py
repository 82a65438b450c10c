"""Tokenizing, packing and token files against the tokenizer itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from llm_small import AWKWARD, SF_DIR
from larder.llm import packing, queries, tokenfiles
from larder.llm.tokens import Encoder
from larder.session import scratch_dir

CODERS = {"blank": Encoder(queries.BYTE_BPE, "blank"), "word": Encoder(queries.WORD_BPE, "word")}
PIECES = st.sampled_from([" ", "  ", "\n", " \n", "\n\n", "\t", "a", "word", "Wörd", "é", "é", "'s", "!!",
                          "1", "ß", "Σ", "漢", "😀", "İ", "<|endoftext|>", "\x1c", " ", " ", "\x00", ","])


def whole(cut, text):
    ids = CODERS[cut].tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4")


@pytest.mark.parametrize("cut", CODERS)
@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=30).map("".join) | st.text(max_size=60))
def test_parts_give_the_ids_of_the_whole(cut, text):
    assert CODERS[cut].encode([text])[0] == whole(cut, text).tobytes()


@pytest.mark.parametrize("cut", CODERS)
def test_real_texts(cut, texts):
    for text in texts.values():
        assert CODERS[cut].encode([text])[0] == whole(cut, text).tobytes()


def test_the_memory_of_parts_is_bounded(monkeypatch):
    from larder.llm import tokens

    monkeypatch.setattr(tokens, "KEEP", 10)
    coder = Encoder(queries.BYTE_BPE, "blank")
    text = " ".join(f"word{chr(97 + k % 26)}{'x' * (k % 7)}" for k in range(200))
    assert coder.encode([text, text])[1] == whole("blank", text).tobytes()
    assert len(coder.parts) <= 10 and len(coder.parts.older) <= 10


LATIN = st.sampled_from([", ", ". ", ",", ".", "%", "'s", "'S ", "a", "Word", "É", "ß", "µ", "²", "1", "\xa0", "\x85", "\x1c", "\xad", "\n"])


@pytest.mark.parametrize("cut", CODERS)
@settings(max_examples=300, deadline=None)
@given(st.lists(LATIN, max_size=30).map("".join) | st.text(st.characters(max_codepoint=255), max_size=60))
def test_parts_of_latin_texts(cut, text):
    assert CODERS[cut].encode([text])[0] == whole(cut, text).tobytes()


@pytest.mark.parametrize("cut", CODERS)
def test_a_sent_encoder_gives_the_same_ids(cut):
    text = "漢 \x1c <|endoftext|> word"
    CODERS[cut].encode([text, "more words"])
    sent = cloudpickle.loads(cloudpickle.dumps(CODERS[cut]))
    assert sent.encode([text])[0] == whole(cut, text).tobytes() and "more" not in sent.parts


def test_capitals_and_closing_marks_share_a_part():
    coder = Encoder(queries.WORD_BPE, "word")
    text = "Été, été. ÉTÉ, Word. word, WORD été"
    assert coder.encode([text])[0] == whole("word", text).tobytes()
    assert set(coder.parts) <= {"été", "word", ",", ".", ""}


def check_packed(rows, texts, end, capacity=1024):
    """texts: (doc_id, text) of all rows; returns the number of sequences."""
    want = sorted(((d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for d, t in texts
                   for ids in [np.append(whole("blank", t), np.uint32(end)).astype("<u4")]
                   for n in [len(ids)]
                   for bounds in [[0, *range((n - 1) % capacity + 1, n + 1, capacity)]]
                   for k, (a, b) in enumerate(zip(bounds, bounds[1:]))), key=repr)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_query_packs_all_documents(spark, texts):
    rows = queries.op1_best_fit_packing(spark, SF_DIR).collect()
    made = check_packed(rows, texts.items(), queries.PACK_END)
    assert made <= np.ceil(sum(r.length for r in rows) / 1024) * 1.1


def test_awkward_documents(awkward, nothing):
    rows = packing.pack_documents(awkward, queries.BYTE_BPE, "blank", 2).collect()
    check_packed(rows, AWKWARD, 2)
    assert packing.pack_documents(nothing, queries.BYTE_BPE, "blank", 2).collect() == []


def test_sequences_hold_the_ids(awkward):
    packed = packing.pack_documents(awkward, queries.BYTE_BPE, "blank", 2, with_ids=True)
    made = packing.sequences(packed).collect()
    assert all(r.n_tokens == len(r.ids) <= 1024 for r in made)
    assert sum(r.n_tokens for r in made) == sum(len(whole("blank", t)) + 1 for _, t in AWKWARD)


def test_best_fit_and_the_fullest_closes():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(5) == (1, 0)
    assert bins.place(4) == (0, 6)            # fits both, best in the fuller
    assert bins.place(6) == (2, 0)            # open: 1 with 5 free, 2 with 4 free
    assert bins.place(7) == (3, 0)            # the fullest, 2, closes
    assert bins.place(3) == (3, 7) and bins.place(4) == (1, 5)
    with pytest.raises(ValueError):
        bins.place(11)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=200), st.integers(1, 5))
def test_bins_never_overflow(sizes, most):
    bins, used = packing.OpenBins(20, most), defaultdict(int)
    for size in sizes:
        b, offset = bins.place(size)
        assert offset == used[b]
        used[b] += size
        assert used[b] <= 20 and bins.open <= most


def test_query_reads_the_files_back(spark, texts):
    rows = queries.op10_token_files(spark, SF_DIR).collect()
    start = 0
    assert len(rows) == len(texts)
    for r in sorted(rows, key=lambda r: r.doc_id):
        ids = np.append(whole("word", texts[r.doc_id]), np.uint32(1)).astype("<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("vocabulary", [queries.WORD_BPE_IDS, 1 << 20])
def test_files_of_awkward_documents(spark, awkward, nothing, vocabulary):
    out = scratch_dir(spark, "files")
    tokenfiles.write(awkward, out, queries.WORD_BPE, "word", 1, vocabulary)
    rows = sorted(tokenfiles.read(spark, out, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((d for d, _ in AWKWARD), key=lambda d: -2 ** 63 if d is None else d)
    want = sorted(((d, [*whole("word", t).tolist(), 1]) for d, t in AWKWARD), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in rows), key=repr) == want
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows]).tolist()[:-1]]
    found = tokenfiles.lookup(spark, out, [6, 10]).collect()
    assert {r.doc_id: r.ids for r in found} == {d: ids for d, ids in want if d in (6, 10)}
    empty = scratch_dir(spark, "files")
    tokenfiles.write(nothing, empty, queries.WORD_BPE, "word", 1, vocabulary)
    assert tokenfiles.read(spark, empty).collect() == []


def test_another_dictionary_is_refused(spark, documents):
    out, other = scratch_dir(spark, "files"), scratch_dir(spark, "files")
    tokenfiles.write(documents.limit(5), out, queries.WORD_BPE, "word", 1, queries.WORD_BPE_IDS)
    spark.createDataFrame([("0" * 64, bytearray(b"x" * 100))], "dictionary string, data binary").write.parquet(f"{other}/dictionary")
    tokenfiles._blocks(spark, out).write.parquet(f"{other}/blocks")
    with pytest.raises(Exception, match="dictionary"):
        tokenfiles.read(spark, other).collect()
