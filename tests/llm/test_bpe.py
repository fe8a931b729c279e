"""BPE: ids and texts equal those of the tokenizers library; the stream needs bounded memory."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return bpe.Vocabulary(file.read())


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def ids_of(vocabulary, text):
    return [i for part in vocabulary.encode(text) for i in part]


PARTS = ["a", "e", "th", "ing", " ", "  ", "\n", "é", "ß", "中", "\U0001f600", "'s", "'ll", "1", "23", ".", "!!", "\t", " ", "<|endoftext|>", "x" * 70, "́", "ñ", "٣", "Ⅳ", "²"]


def test_random_texts(vocabulary, reference):
    rnd = random.Random(0)
    for _ in range(1500):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 50)))
        ids = ids_of(vocabulary, text)
        assert ids == reference.encode(text, add_special_tokens=False).ids
        assert "".join(vocabulary.decode([ids])) == text


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 6000 + "q" * 300, "!" * 4000 + "?!" * 2000, " " * 8000, "ingtionther" * 1500, "中文字" * 2000, "1234567890" * 900])
def test_long_pieces_stream(vocabulary, reference, text):
    assert ids_of(vocabulary, text) == reference.encode(text, add_special_tokens=False).ids


def test_slices_end_between_words(vocabulary, reference, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 20)
    text = "The quick  brown fox's 12 jumps, over\n\n the lazy dog " * 20
    assert ids_of(vocabulary, text) == reference.encode(text, add_special_tokens=False).ids


def test_lookahead_suffices_for_a_small_merge_list():
    """Every token that ends `lookahead` before the end of a prefix is final, on all short strings."""
    rules = [(97, 98, 256), (98, 99, 257), (256, 99, 258), (97, 97, 259), (257, 97, 260), (259, 256, 261)]
    size = {**{c: 1 for c in (97, 98, 99)}, 256: 2, 257: 2, 258: 3, 259: 2, 260: 3, 261: 4}
    small = bpe.Vocabulary.__new__(bpe.Vocabulary)
    small.first, small.rules = list(range(256)), {(u, v): (k, w) for k, (u, v, w) in enumerate(rules)}
    ahead = bpe.lookahead(rules, size.__getitem__)
    rnd = random.Random(4)
    for _ in range(3000):
        text = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 18)))
        whole = small.merged(text)
        assert whole == small.merged_short(text)
        cut = rnd.randint(0, len(text))
        at = 0
        for mine, final in zip(small.merged(text[:cut]), whole):
            at += size[mine]
            if at > cut - ahead:
                break
            assert mine == final


def test_incomplete_characters_wait_and_bad_bytes_are_replaced(vocabulary, reference):
    ids = reference.encode("中é", add_special_tokens=False).ids
    assert "".join(vocabulary.decode([[i] for i in ids])) == "中é"
    assert "".join(vocabulary.decode([ids[:1]])) == reference.decode(ids[:1], skip_special_tokens=False)


def test_round_trip_of_documents_and_odd_rows(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "<|endoftext|>x"), (None, "a b"), (-3, "<|endoftext|>x")], docs.schema)
    rows = docs.union(odd).selectExpr("*", "1 AS n_tokens")
    text = {r.doc_id: r.text or "" for r in rows.collect()}
    out = bpe.round_trip(rows).collect()
    assert len(out) == rows.count()
    for r in out:
        ids = reference.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    both = bpe.decode(bpe.encode(rows))
    assert both.where("NOT decoded <=> coalesce(text, '')").count() == 0
    assert bpe.round_trip(rows.limit(0)).collect() == [] and bpe.encode(rows.limit(0)).collect() == []
