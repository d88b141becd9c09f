import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from lakekit.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")
SMALL = [("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -3.0), ("ba", -2.0), ("aba", -3.0), ("▁▁", -1.5), ("c", -0.5), ("cc", -1.0), ("xyz", -4.0)]


def library(pieces, byte_fallback, split=True):
    t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=split)
    return t


@pytest.mark.parametrize("small", [True, False])
def test_counts_equal_the_library(small):
    pieces = SMALL if small else tc.unigram_pieces(PATH)
    theirs, ours = library(pieces, not small), tc.UnigramCounter(pieces)
    rnd = random.Random(3)
    alphabet = "abcxyz ▁é🙂\n" if small else "abc th<s>▁  \n日☃🙂é<0x0A>unk"
    for _ in range(8000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(24)))
        assert ours.text(text)[0] == len(theirs.encode(text, add_special_tokens=False).ids), repr(text)


def test_ties_and_scores():
    ours = tc.UnigramCounter(SMALL)
    # "▁a" + "b" and "▁" + "ab" both cost 4: the leftmost start of the last piece wins
    assert ours.text("ab") == (2, -4.0)
    assert ours.text("") == (0, 0.0)


def test_long_word():
    theirs, ours = library(tc.unigram_pieces(PATH), True), tc.counter(PATH)
    for text in ("a" * 20_000, "thing" * 3000, "☃" * 2000, " " * 500):
        assert ours.text(text)[0] == len(theirs.encode(text, add_special_tokens=False).ids)


def test_table(llm):
    df = llm.createDataFrame([(1, None, 5), (2, "", 5), (3, "Hello world", 5), (3, "Hello world", 5)], "doc_id long, text string, score int")
    rows = [tuple(r)[:2] for r in tc.unigram_token_counts(df, PATH).collect()]
    assert sorted(rows) == [(1, 0), (2, 0), (3, 6), (3, 6)]
    assert tc.unigram_token_counts(df.limit(0), PATH).count() == 0


CROSSING = [*SMALL, ("b▁a", -1.2), ("▁▁▁c", -2.2)]


@pytest.mark.parametrize("pieces", ["small", "crossing", "no mark", "file"])
def test_pieces_over_marks_without_splitting(pieces):
    """Runs of marks are pieces, or pieces go over a mark: the cuts follow the vocabulary."""
    known = {"small": SMALL, "crossing": CROSSING, "no mark": [p for p in SMALL if p[0] != "▁"], "file": tc.unigram_pieces(PATH)}[pieces]
    theirs, ours = library(known, pieces == "file", split=False), tc.UnigramCounter(known, splits=False)
    assert ours.cuts == (pieces in ("small", "file"))
    rnd = random.Random(4)
    alphabet = "abc th  \n▁日🙂é" if pieces == "file" else "abcxyz   ▁é"
    for _ in range(4000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(24)))
        assert ours.text(text)[0] == len(theirs.encode(text, add_special_tokens=False).ids), repr(text)
