"""Token counts and BPE against the tokenizers library."""

import hashlib

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import ODD, SMALL, frame, fuzz
from trafficcast.llm import bpe, bytesops
from trafficcast.llm.token_counts import count_slice, op1_token_counts, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [*"ab cdeEÉ\n\t's' 12٣½  \u0085　 \x1cćéΣσİK日本語🙂.,!?-", "<|endoftext|>", "<|startoftext|>", "  ", "'re", "the", "ing", "́"]


@pytest.fixture(scope="module")
def odd(texts):
    return [t or "" for t in ODD] + fuzz(1500, ALPHABET, 50) + texts[:60]


def test_counts_equal_the_library(odd):
    expected = [len(e) for e in Tokenizer.from_file(BYTES).encode_batch(odd, add_special_tokens=False)]
    assert count_slice(pa.array(odd), BYTES).tolist() == expected


def test_ids_and_decoding_equal_the_library(odd):
    library, vocab = Tokenizer.from_file(WORDS), bpe.vocabulary(WORDS)
    expected = [e.ids for e in library.encode_batch(odd, add_special_tokens=False)]
    found = bpe.encode_slice(pa.array(odd), vocab)
    assert found.to_pylist() == expected
    assert bpe.decode_slice(found, vocab).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in expected]


def test_every_failing_guess_is_caught():
    vocab = bpe.vocabulary(WORDS)
    words = [w for w in fuzz(4000, "abcdeinghtrsou", 14, 3) if w]
    guesses = [vocab.propose(w) for w in words]
    exact = [vocab.exact(w) for w in words]
    assert vocab.encode_words(words) == exact
    assert any(a != b for a, b in zip(guesses, exact, strict=True))


def test_operators_on_odd_rows(spark):
    docs = frame(spark, ODD)
    counts = {r.doc_id: r for r in token_counts(docs, BYTES).collect()}
    library = Tokenizer.from_file(BYTES)
    for i, t in enumerate(ODD):
        assert counts[i].n_bytes == len((t or "").encode())
        assert counts[i].n_tokens == len(library.encode(t or "", add_special_tokens=False))
    encoded = bpe.encode_decode(docs, WORDS)
    again = {r.doc_id: r.decoded for r in bpe.decode(encoded, WORDS).collect()}
    library = Tokenizer.from_file(WORDS)
    for r in bpe.digests(encoded).collect():
        ids = library.encode(ODD[r.doc_id] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert again[r.doc_id] == text


def test_empty_table_and_null_key(spark):
    none = frame(spark, ["x"]).limit(0)
    assert token_counts(none, BYTES).count() == 0
    assert bpe.encode_decode(none, WORDS).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert [r.n_tokens for r in token_counts(nulls, BYTES).collect()] == [2, 2]


def test_queries_cover_the_table(spark):
    assert op1_token_counts(spark, SMALL).count() == 200
    assert bpe.op3_bpe(spark, SMALL).count() == 200


def _twins(letters, size):
    """A Thue-Morse string and its complement, which any polynomial modulo a power of two takes for one."""
    bits = [bin(i).count("1") % 2 for i in range(size)]
    return ["".join(letters[b ^ flip] for b in bits) for flip in (0, 1)]


@pytest.mark.parametrize("letters", ["es", "ab", "th", "xq", "01"])
@pytest.mark.parametrize("size", [1024, 4096])
def test_equal_hashes_are_not_taken_for_equal_texts(letters, size):
    texts = _twins(letters, size) * 2
    counts = [len(e) for e in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]
    ids = [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]
    vocab = bpe.vocabulary(WORDS)
    assert count_slice(pa.array(texts), BYTES).tolist() == counts
    assert bpe.encode_slice(pa.array(texts), vocab).to_pylist() == ids
    for i, text in enumerate(texts):
        assert count_slice(pa.array([text]), BYTES).tolist() == [counts[i]]
        assert bpe.encode_slice(pa.array([text]), vocab).to_pylist() == [ids[i]]


def test_spans_of_equal_hash_are_told_apart():
    texts = [*_twins("es", 1024), "a", "b", "a", "", _twins("es", 1024)[1]]
    data, offsets = bytesops.text_bytes(pa.array(texts))
    first, back = bytesops.distinct_spans(data, offsets[:-1], offsets[1:])
    assert [texts[i] for i in first[back]] == texts
    assert len(first) == len(set(texts))
