"""BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a piece there is exactly one token that can be last in the prefix's
BPE encoding.  The suffix automaton of the vocabulary follows the longest suffix of the prefix that
lies in some token; the tokens among its suffixes are those that end there, and the one that
starts where a prefix ends whose own last token it is compatible with is the answer.  Following the stored tokens back from the end gives the exact ids,
in time linear in the piece, without simulating merges over it.

Two tokens are compatible when merging their joined symbols never merges across their
border.  Only the symbols that touch the border matter: the right edges of the left
token's merge tree and the left edges of the right one's.

Pieces are memoised per Python worker (bounded), so Zipf-distributed words are encoded once.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakekit.llm.common import WordCache, chunks, focus, held

PIECE_CACHE = 200_000    # memoised pieces per generation and worker
CHUNK_CACHE = 50_000     # the same for chunks in rare scripts
PAIR_CACHE = 1_000_000
WORD_END = "</w>"
NEVER = 1 << 60
# Texts of these characters need no composition and lower-case one to one; a faster pattern does.
_PLAIN = re.compile("[\\t-\\r -~\u00a1-\u012f\u0131-\u017f]*")
# Fixed value: the split pattern of word-end BPE vocabularies of this kind, for lower-case plain text.
_PLAIN_PIECES = re.compile(r"[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f]+|'(?:s|t|re|ve|m|ll|d)|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|[^\sa-z0-9\u00aa\u00b2\u00b3\u00b5\u00b9\u00ba\u00bc-\u00be\u00df-\u00f6\u00f8-\u017f]+")


def byte_alphabet() -> list[str]:
    """One printable character for each byte: printable Latin-1 bytes stand for themselves,
    the others follow from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(extra)) for b in range(256)]


class SuffixAutomaton:
    """All stretches of the given words, as states with transitions and suffix links.

    A state stands for stretches with the same ends, the longest of ``length`` characters; its
    link leads to the longest suffix that has more ends.  ``word[s]`` is the word that a state's
    longest stretch is, ``ends[s]`` the nearest state on the way up the links that has one.
    """

    def __init__(self, words: dict[str, int]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        at: list[tuple[int, int]] = []
        for text, word in words.items():
            state = 0
            for c in text:
                state = self._extended(state, c)
            at.append((state, word))
        self.word = [-1] * len(self.link)
        for state, word in at:      # the state that a whole word leads to has its length
            self.word[state] = word
        self.ends = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.ends[state] = state if self.word[state] >= 0 else self.ends[self.link[state]]

    def _new(self, length: int, link: int, follow: dict[str, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, c: str, of: int) -> int:
        """A state of its own for the stretches of ``of`` that are one longer than ``state``'s."""
        clone = self._new(self.length[state] + 1, self.link[of], dict(self.next[of]))
        self.link[of] = clone
        while state >= 0 and self.next[state].get(c) == of:
            self.next[state][c] = clone
            state = self.link[state]
        return clone

    def _extended(self, state: int, c: str) -> int:
        """The state of the stretch that ``state``'s longest and ``c`` make."""
        known = self.next[state].get(c)
        if known is not None:
            return known if self.length[known] == self.length[state] + 1 else self._split(state, c, known)
        made = self._new(self.length[state] + 1, 0, {})
        while state >= 0 and c not in self.next[state]:
            self.next[state][c] = made
            state = self.link[state]
        if state >= 0:
            below = self.next[state][c]
            self.link[made] = below if self.length[below] == self.length[state] + 1 else self._split(state, c, below)
        return made

    def matches(self, text: str):
        """(end, length, word) of all words in ``text``, by end, longest first."""
        follow, link, length, word, ends = self.next, self.link, self.length, self.word, self.ends
        state = matched = 0
        for end, c in enumerate(text, 1):
            while state and c not in follow[state]:
                state = link[state]
                matched = length[state]
            state = follow[state].get(c, 0)
            matched = matched + 1 if state else 0
            # only the state's own word can be longer than what is matched
            found = ends[state]
            if found == state and length[state] > matched:
                found = ends[link[state]]
            while found > 0:
                yield end, length[found], word[found]
                found = ends[link[found]]


class PrefixEncoder:
    """Exact encoder of a word-end BPE vocabulary (``merges`` in training order)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
            raise ValueError("a BPE vocabulary with word-end symbols is needed")
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(self.letters)}
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        # end[c]: the one-character stand-in for the symbol c with a word end
        self.end = {c: chr(0xE000 + b) for b, c in enumerate(self.letters)}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, whole = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if whole in self.parts or rank <= max(self.rank.get(left, -1), self.rank.get(right, -1)):
                raise ValueError("each token needs one merge, after those of its parts")
            self.rank[whole], self.parts[whole], self.joined[left, right] = rank, (left, right), rank
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo = WordCache(self.encode_piece, PIECE_CACHE)
        self.rare = WordCache(self._rare_pieces, CHUNK_CACHE)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(symbol, rank of the merge that consumes it) along one side of a token's merge tree."""
        found = self.edges.get((token, side))
        if found is None:
            found, consumed, at = [], NEVER, token
            while True:
                found.append((at, consumed))
                if at not in self.parts:
                    break
                consumed, at = self.rank[at], self.parts[at][side]
            self.edges[token, side] = found
        return found

    def _crosses(self, left: int, right: int, until: int = NEVER) -> bool:
        """Whether some merge before ``until`` joins symbols of both tokens.  Of equal merges
        the leftmost is made first: inside ``left`` before, inside ``right`` after the border's."""
        joined = self.joined
        for x, x_gone in self._edge(left, 1):
            x_gone = min(x_gone, until)
            for y, y_gone in self._edge(right, 0):
                rank = joined.get((x, y))
                if rank is not None and rank < x_gone and rank <= y_gone and rank < until:
                    return True
        return False

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            known = self.pairs[key] = not self._crosses(left, right)
        return known

    @functools.cached_property
    def automaton(self) -> SuffixAutomaton:
        """Of the tokens that an encoding can hold; made when the first piece is encoded."""
        reachable: dict[int, bool] = {}
        for token, (left, right) in self.parts.items():  # in rank order: parts come first
            reachable[token] = reachable.get(left, True) and reachable.get(right, True) and not self._crosses(left, right, self.rank[token])
        words = {}
        for text, token in self.vocab.items():
            if token in self.special.values() or not reachable.get(token, True):
                continue
            if text.endswith(WORD_END) and text != WORD_END:
                bare = text[: -len(WORD_END)]
                text = bare[:-1] + self.end[bare[-1]]
            words[text] = token
        return SuffixAutomaton(words)

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece (a special token's string is its own)."""
        if piece in self.special:
            return [self.special[piece]]
        if not piece.isascii():
            letters = self.letters
            piece = "".join([letters[b] for b in piece.encode()])
        elif not piece.isprintable():
            piece = "".join([self.letters[b] for b in piece.encode()])
        symbols = piece[:-1] + self.end[piece[-1]]
        whole = len(symbols)
        last = [-1] * (whole + 1)       # unique last token of each prefix
        size = [0] * (whole + 1)
        pairs, compatible = self.pairs, self.compatible
        for end, length, token in self.automaton.matches(symbols):
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                fits = pairs.get((before, token))
                if fits is None:
                    fits = compatible(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        ids = []
        while whole:
            ids.append(last[whole])
            whole -= size[whole]
        ids.reverse()
        return ids

    def _rare_pieces(self, chunk: str) -> list[str]:
        """Pieces of a chunk by the tokenizer's own normalizer and Unicode tables."""
        out = []
        for part in self.split_special.split(chunk) if self.split_special else [chunk]:
            if part in self.special:
                out.append(part)
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                out += [bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def pieces(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return _PLAIN_PIECES.findall(text.lower())
        return [p for chunk in chunks(text) for p in self.rare[chunk]]

    def encode(self, text: str) -> list[int]:
        return [i for ids in map(self.memo.__getitem__, self.pieces(text)) for i in ids]

    def decode(self, ids) -> str:
        """As a tokenizer without a decoder does: the tokens' strings with a space between."""
        return " ".join(self.names[i] for i in ids if i in self.names)


@held
def encoder(path: str) -> PrefixEncoder:
    """One encoder per Python worker and vocabulary file."""
    return PrefixEncoder(path)


@held
def _rendered(path: str) -> WordCache:
    enc = encoder(path)

    def render(piece: str) -> tuple[str, str]:
        ids = enc.encode_piece(piece)
        return " ".join(map(str, ids)), enc.decode(ids)

    return WordCache(render, PIECE_CACHE)


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode it again: id, n_tokens, ids_sha256, decoded_sha256.

    One row per input row (repeated rows stay); a NULL text counts as empty and has no
    tokens; other columns are left out, whatever their names.  Nothing is shuffled.
    """
    def digest(batches):
        focus(encoder, _rendered)
        pieces, rendered = encoder(path).pieces, _rendered(path).__getitem__
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                parts = [*map(rendered, pieces(text or ""))]
                ids = " ".join([p[0] for p in parts])
                n.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(" ".join([p[1] for p in parts]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(digest, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def bpe_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids themselves and the decoded text, one row per input row."""
    def run(batches):
        focus(encoder)
        enc = encoder(path)
        for batch in batches:
            ids = [enc.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(enc.decode, ids), pa.string())],
                names=[id_col, "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")
