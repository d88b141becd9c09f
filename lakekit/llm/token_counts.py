"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each position; dynamic
programming carries, for each position, the best score and the number of pieces of the
path that has it.  No lattice, back-pointer or piece list is kept.  Ties go as in the
tokenizers library's unigram model: a later candidate wins only with a strictly higher
score, candidates of one end come from the leftmost start on, and a character without a
piece of its own costs the lowest score less 10 and counts its UTF-8 bytes when the
vocabulary holds all byte pieces, else one for each run of such characters.

Words (cut before each space, a space stands for the word mark) are scored apart and
memoised per Python worker, bounded.  For a tokenizer that doesn't split at spaces the cuts come
from the vocabulary: where no piece holds a mark after another character, text is cut before
each run of marks, and pieces of several marks can match; else it isn't cut.
"""

from __future__ import annotations

import math
import re

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import WordCache, focus, held

WORD_CACHE = 400_000    # memoised words per generation and worker
MARK = "▁"
UNKNOWN_PENALTY = 10.0
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")


def unigram_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece vocabulary file, in id order."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    """``splits``: whether the tokenizer cuts text before each space, whatever the pieces are."""

    def __init__(self, pieces: list[tuple[str, float]], splits: bool = True):
        scores = dict(pieces)
        self.splits = splits
        # an unknown character's run could go on over a mark that is no piece
        self.cuts = MARK in scores and not any(re.search(f"[^{MARK}]{MARK}", p) for p in scores)
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in scores for b in range(256))
        self.single = {p for p in scores if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.words = WordCache(self.word, WORD_CACHE)

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of a word, its mark put in front."""
        text = MARK + word
        size = len(text)
        best = [-math.inf] * (size + 1)
        count = [0] * (size + 1)
        best[0] = 0.0
        odd = [i for i, c in enumerate(text) if c not in self.single]
        if odd:
            return self._word_with_unknown(text, odd)
        for at, (length, score) in self.automaton.iter(text):
            start = at + 1 - length
            total = best[start] + score
            if total > best[at + 1]:
                best[at + 1], count[at + 1] = total, count[start] + 1
        return count[size], best[size]

    def _word_with_unknown(self, text: str, odd: list[int]) -> tuple[int, float]:
        size = len(text)
        best = [-math.inf] * (size + 1)
        count = [0] * (size + 1)
        in_run = [False] * (size + 1)   # the path's last piece is unknown
        best[0] = 0.0
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
        for at, (length, score) in self.automaton.iter(text):
            ending[at + 1].append((length, score))
        unknown = set(odd)
        for end in range(1, size + 1):
            for length, score in ending[end]:
                total = best[end - length] + score
                if total > best[end]:
                    best[end], count[end], in_run[end] = total, count[end - length] + 1, False
            if end - 1 in unknown:
                total = best[end - 1] + self.unknown
                if total > best[end]:
                    more = len(text[end - 1].encode()) if self.bytes else int(not in_run[end - 1])
                    best[end], count[end], in_run[end] = total, count[end - 1] + more, True
        return count[size], best[size]

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if not self.splits:
            marked = text.replace(" ", MARK)
            marked = marked if marked.startswith(MARK) else MARK + marked
            parts = [self.words[p[1:]] for p in (_RUNS.findall(marked) if self.cuts else [marked])]
            return sum([p[0] for p in parts]), math.fsum([p[1] for p in parts])
        text = text.replace(MARK, " ")
        parts = [*map(self.words.__getitem__, (text[1:] if text[0] == " " else text).split(" "))]
        return sum([p[0] for p in parts]), math.fsum([p[1] for p in parts])


@held
def counter(path: str) -> UnigramCounter:
    """One counter per Python worker and vocabulary file."""
    return UnigramCounter(unigram_pieces(path))


def unigram_token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text: id, n_tokens, score (the best path's log score).

    One row per input row; a NULL or empty text has 0 tokens and score 0; other columns are
    left out, whatever their names.  Nothing is shuffled.
    """
    def run(batches):
        focus(counter)
        count = counter(path).text
        for batch in batches:
            found = [count(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())],
                names=[id_col, "n_tokens", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, score double")
