import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lagscope.llm import queries, tokens
from lagscope.session import scratch_dir


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.TOKENIZER)


def whole_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 20_000])
def test_hash_is_perfect_and_minimal(n):
    hashes, _ = tokens.key_hashes(pa.array(np.arange(n) * 31))
    slots = tokens.find_slots(hashes, tokens.build_mph(hashes), n)
    assert sorted(slots.tolist()) == list(range(n))


def test_keys_of_any_type_and_null_have_hashes_of_their_own():
    hashes, prints = tokens.key_hashes(pa.array(["", "0", None, "00", "a"]))
    assert len(set(hashes.tolist())) == len(set(prints.tolist())) == 5


def test_words_encode_as_in_the_whole_text(tokenizer):
    texts = [
        "Hello, world's  END\nnew\tline", "", "don't 'S x's !'s a,b;c 12345 <|endoftext|>x", "étude, café.",
        "Größe ΟΔΟΣ  non-breaking space 　 中文 😀😀", "a\x0bb\x0cc\x1cd\x85e",
    ]
    from lagscope.llm import lexing as lx

    data, offsets = lx.text_bytes(pa.array(texts))
    ids, n = tokens.Encoder(queries.TOKENIZER).encode(data, offsets)
    assert ids.tolist() == [i for t in texts for i in whole_ids(tokenizer, t)]
    assert n.tolist() == [len(whole_ids(tokenizer, t)) for t in texts]


@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x250, exclude_categories=["Cs"]), max_size=25), max_size=6))
@settings(max_examples=300, deadline=None)
def test_any_text_encodes_as_a_whole(texts):
    from tokenizers import Tokenizer

    from lagscope.llm import lexing as lx

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    ids, _ = tokens.Encoder(queries.TOKENIZER).encode(*lx.text_bytes(pa.array(texts, pa.string())))
    assert ids.tolist() == [i for t in texts for i in whole_ids(tokenizer, t)]


def test_a_full_memory_of_words_is_emptied(tokenizer, monkeypatch):
    from lagscope.llm import lexing as lx

    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    encoder = tokens.Encoder(queries.TOKENIZER)
    for texts in (["a b c d e"], ["f a é g", "h"], ["a b c d e"]):
        ids, _ = encoder.encode(*lx.text_bytes(pa.array(texts)))
        assert ids.tolist() == [i for t in texts for i in whole_ids(tokenizer, t)]


def test_odd_rows_round_trip(spark, odd, tokenizer):
    files = tokens.write_tokens(odd, scratch_dir(spark, "tokens"), queries.TOKENIZER)
    rows = queries.token_digests(files, odd).collect()
    assert len(rows) == odd.count()
    expected = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len(i := whole_ids(tokenizer, r["text"])), crc(i)) for r in odd.collect())
    found = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert found == expected
    # One document begins where the one before ends, in ascending order of their keys.
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))


def test_unknown_keys_are_told_apart(spark, odd):
    files = tokens.write_tokens(odd, scratch_dir(spark, "tokens"), queries.TOKENIZER)
    asked = spark.range(0, 2000).withColumnRenamed("id", "doc_id")
    assert {r["key"] for r in files.locate(asked, "doc_id").collect()} == {1, 2, 3, 4, 5, 6, 7, 8}


def test_index_in_several_parts(spark, monkeypatch):
    monkeypatch.setattr(tokens, "KEYS_PER_PART", 50)
    docs = spark.range(500).select(F.concat(F.lit("k"), "id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    files = tokens.write_tokens(docs, scratch_dir(spark, "tokens"), queries.TOKENIZER)
    assert files.n_parts == 10
    assert files.locate(docs, "doc_id").count() == 500


def test_no_rows(spark, nothing):
    files = tokens.write_tokens(nothing, scratch_dir(spark, "tokens"), queries.TOKENIZER)
    assert queries.token_digests(files, nothing).count() == 0


def test_query(spark, sf_dir, tokenizer):
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.token_files(spark, sf_dir).collect()}
    at = 0
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = whole_ids(tokenizer, row["text"])
        assert found[row["doc_id"]] == (at, len(ids), crc(ids))
        at += len(ids)


def test_equal_hashes_get_another_seed():
    """Keys that share their first hash have slots by their second one."""
    hashes = np.array([5, 5, 9, 5, 1], np.uint64)
    prints = np.array([1, 2, 3, 4, 4], np.uint64)
    seed = tokens.choose_seed(hashes, prints)
    own = tokens.seeded(hashes, prints, seed)
    assert sorted(tokens.find_slots(own, tokens.build_mph(own), 5).tolist()) == list(range(5))


def test_no_slots_for_keys_that_cannot_be_told_apart():
    same = np.array([5, 5, 9], np.uint64)
    with pytest.raises(ValueError):
        tokens.choose_seed(same, same)
    with pytest.raises(ValueError):
        tokens.build_mph(same)


def test_the_two_hashes_are_unlike():
    """Agreement in one says nothing of the other: their low bits meet as often as chance has it."""
    hashes, prints = tokens.key_hashes(pa.array(np.arange(20_000)))
    low = np.uint64(0xFFFF)
    assert abs(np.mean(hashes & low == prints & low) - 2**-16) < 1e-3
    alike = np.flatnonzero(np.diff(np.sort(hashes & low)) == 0)
    assert len(alike) > 1000 and len(np.unique(prints)) == 20_000


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_file(spark, odd, name):
    """Also of a tokenizer that keeps white space and so cannot be given single words."""
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path(name)
    whole = Tokenizer.from_file(file)
    files = tokens.write_tokens(odd, scratch_dir(spark, "tokens"), file)
    found = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in queries.token_digests(files, odd).collect())
    expected = sorted((r["doc_id"] or 0, len(i := whole_ids(whole, r["text"])), crc(i)) for r in odd.collect())
    assert found == expected


def test_an_encoder_is_kept_between_tasks():
    assert tokens.kept_encoder(queries.TOKENIZER) is tokens.kept_encoder(queries.TOKENIZER)
