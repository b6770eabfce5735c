import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from delaystar.llm import bpe
from tests.llm.helpers import documents

PIECES = ["a", "B", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "'s", "'ll", "\xe9", "\xdf", "1", "\u0663", "\xbd", "\xb2", "\u4e2d", "\U0001f600", "!", "_", "-",
          "\xa0", "\u2003", "\u3000", "\x1c", "\x85", "\u0301", "\xaa", "'", "\u2167", "\u200b", "the", "ing", "<|endoftext|>", "<|", "|>", "\ufeff", "\x00"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))


def texts(n=4000):
    rnd = random.Random(5)
    made = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 25))) for _ in range(n)]
    return [*made, "", " ", "a" * 3000, "ab cd" * 2000, "=" * 5000, " " * 200, "x" + "\n" * 50]


@pytest.mark.parametrize("size", [0, 300])
def test_ids_and_decoding_equal_the_library(reference, size):
    cases = texts()
    vocabulary = bpe.Vocabulary(bpe.TOKENIZER)
    some = {w.encode() for t in cases[:1000] for w in bpe.patterns().words.findall(t)}
    lexicon = bpe.Lexicon(bpe.pack_arrays(bpe.compile_lexicon(sorted(some)[:size], vocabulary))) if size else None
    encoder = bpe.Encoder(bpe.TOKENIZER, lexicon)
    for start in range(0, len(cases), 500):
        batch = cases[start : start + 500]
        for text, ids, want in zip(batch, encoder.encode_batch(batch), reference.encode_batch(batch, add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, text
            assert encoder.decode(ids).decode() == reference.decode(want.ids, skip_special_tokens=False)


def test_small_caches_change_nothing(monkeypatch):
    cases = texts(1500)
    whole = bpe.Encoder(bpe.TOKENIZER, None).encode_batch(cases)
    monkeypatch.setattr(bpe, "CACHE_UNITS", 50)
    encoder = bpe.Encoder(bpe.TOKENIZER, None)
    assert [x for i in range(0, len(cases), 40) for x in encoder.encode_batch(cases[i : i + 40])] == whole


def test_heap_merging_equals_plain_merging():
    vocabulary = bpe.Vocabulary(bpe.TOKENIZER)
    rnd = random.Random(2)
    for _ in range(300):
        word = bytes(rnd.choice(b"theinga rst") for _ in range(rnd.randint(1, 48)))
        assert vocabulary._merge_long([vocabulary.byte_ids[b] for b in word]) == vocabulary.merge(word)


def test_transducer_finds_exactly_its_words_and_shares_suffixes():
    vocabulary = bpe.Vocabulary(bpe.TOKENIZER)
    stems, ends = [b"walk", b"talk", b"jump", b"stalk"], [b"", b"s", b"ed", b"ing", b"ingly"]
    words = [s + e for s in stems for e in ends]
    arrays = bpe.compile_lexicon(words, vocabulary)
    lexicon = bpe.Lexicon(bpe.pack_arrays(arrays))
    ranks = lexicon.ranks(words)
    assert sorted(ranks.tolist()) == list(range(len(words)))
    assert [np.frombuffer(lexicon.ids_of(r), "<u4").tolist() for r in ranks.tolist()] == [vocabulary.merge(w) for w in words]
    assert (lexicon.ranks([b"wal", b"walke", b"x", b"walkinglyy", b"", b"alk"]) == -1).all()
    trie = {w[:i] for w in words for i in range(len(w) + 1)}
    assert len(arrays["final"]) < len(trie) / 2


def test_empty_lexicon():
    lexicon = bpe.Lexicon(bpe.pack_arrays(bpe.compile_lexicon([], bpe.Vocabulary(bpe.TOKENIZER))))
    assert lexicon.ranks([b"a"]).tolist() == [-1]


def test_documents_with_nulls_repeats_and_clashing_columns(spark, reference):
    rows = [(1, None), (2, ""), (3, "the end<|endoftext|> of it"), (3, "the end<|endoftext|> of it"), (None, "no id"),
            (5, "word " * 100_000), (6, "q" * 300_000), *((10 + i, t) for i, t in enumerate(texts(200)))]
    docs = documents(spark, rows, more="ids n_tokens word")
    got = sorted(map(tuple, bpe.token_digests(docs).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        decoded = reference.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_word_counts_cover_all_texts(spark):
    docs = documents(spark, [(1, "aa bb aa"), (2, None), (3, "aa,bb\naa")])
    counts = {bytes(r["word"]): r["n"] for r in bpe.word_counts(docs).collect()}
    assert counts[b"aa"] == 2 and counts[b" aa"] == 2 and counts[b"bb"] == 1 and counts[b" bb"] == 1


def test_empty_table(spark):
    assert bpe.token_digests(documents(spark, [])).count() == 0


@pytest.mark.parametrize("cells", [1, 200, 1 << 18])
def test_merging_many_words_equals_one_by_one(monkeypatch, cells):
    monkeypatch.setattr(bpe, "STEP_CELLS", cells)
    rnd = random.Random(cells)
    vocabulary = bpe.Vocabulary(bpe.TOKENIZER)
    tokens = [t for t in vocabulary.id_bytes.values() if t]
    words = [b"", b"a", b"aaaa", b" the", "é漢😀".encode(), b"x" * 48, b"ab" * 40, bytes(range(48))]
    words += [b"".join(rnd.choices(tokens, k=rnd.randint(1, 4)))[: rnd.randint(1, 60)] for _ in range(800)]
    words += [bytes(rnd.choices(b"etaoin shrdlu", k=rnd.randint(1, 48))) for _ in range(400)]
    got = vocabulary.merge_all(words)
    assert got == [bpe.Encoder.ids_bytes(vocabulary.merge(w)) for w in words]
    assert vocabulary.merge_all([]) == []


def test_the_lexicon_holds_the_vocabulary_and_no_sample_of_texts(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "sample", lambda *a, **k: pytest.fail("texts are sampled"))
    docs = documents(spark, [(1, "zzqx zzqx"), (2, None)])
    assert bpe.token_digests(docs).count() == 2
    lexicon = bpe.Lexicon.open(bpe.build_lexicon(spark))
    tokens = [t for t in bpe.Vocabulary(bpe.TOKENIZER).id_bytes.values() if t and len(t) <= bpe.LEXICON_BYTES]
    assert (lexicon.ranks(tokens) >= 0).all() and lexicon.ranks([b"zzqx"]).tolist() == [-1]
