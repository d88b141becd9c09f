import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakekit.llm import bpe_codec as bc

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aaabbcdeth'ñéß1²٣ \n\x1c\x1d\x85 \xa0́ÅΣİ日本🙂<|startoftext|>.,!#_ªº​﻿ǅKẞ"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def same(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    enc = bc.encoder(PATH)
    assert enc.encode(text) == ids
    assert enc.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_random_texts(library):
    rnd = random.Random(1)
    for _ in range(4000):
        same(library, "".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(16))))


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=40))
def test_any_unicode(library, text):
    same(library, text)


def test_words_of_the_vocabulary_joined(library):
    rnd = random.Random(2)
    words = [w.removesuffix("</w>") for w in bc.encoder(PATH).vocab if w.removesuffix("</w>").isascii()]
    for _ in range(3000):
        same(library, "".join(rnd.choice(words) for _ in range(rnd.randrange(1, 5))))


@pytest.mark.parametrize("text", ["", " ", "a" * 30_000, "!" * 5001, "ab" * 9000 + "é", "<|endoftext|><|startoftext|>a<|endoftext", "don't'll 'S 'rex", "1" * 3000])
def test_long_and_odd_texts(library, text):
    same(library, text)


def test_table(llm, library):
    texts = [None, "", "Hello, world! it's 2024", "repeated", "repeated", "é ñ <|endoftext|>"]
    df = llm.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, ids_sha256 string")
    rows = {r.doc_id: r for r in bc.bpe_digests(df, PATH).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bc.bpe_digests(df.limit(0), PATH).count() == 0
    again = {r.doc_id: r for r in bc.bpe_ids(df, PATH).collect()}
    assert all(again[i].ids == library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts))


def test_memo_is_bounded():
    seen = []
    cache = bc.WordCache(lambda w: seen.append(w) or len(w), 10)
    for k in range(1000):
        assert cache[f"w{k % 37}"] == len(f"w{k % 37}")
        assert len(cache) + len(cache.old) <= 20
    cache["x" * 500]
    assert "x" * 500 not in cache


def test_suffix_automaton_finds_all_words():
    rnd = random.Random(6)
    for _ in range(150):
        words = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))): 0 for _ in range(rnd.randint(1, 25))}
        words = {w: i for i, w in enumerate(words)}
        automaton = bc.SuffixAutomaton(words)
        assert len(automaton.link) <= 2 * sum(map(len, words)) + 1
        text = "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 40)))
        want = [(end, n, words[text[end - n:end]]) for end in range(1, len(text) + 1) for n in range(end, 0, -1) if text[end - n:end] in words]
        assert [*automaton.matches(text)] == want
