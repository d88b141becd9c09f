"""Runs: stretches of words that repeat with a period, at least four times over.

The words of a slice of documents are one sequence, with a mark of its own after each
document.  Prefix doubling gives the suffix array, sorted as deep as the longest block, and
names for all stretches of 2^k words.  A wavelet matrix over the suffix array answers which
occurrence of a block comes next before or after a place.

A run with period q holds an aligned block of 2^k words, q <= 2^k < 2q, that occurs again
q words after or before it, within the neighbouring windows of 2^k words; there its
occurrences are a progression with step q, so the nearest one gives the period.  Candidates
are then extended both ways by comparing names.  Everything is numpy over a slice, none of
it a loop over words.

Why the nearest occurrence is q away: the block starts less than 2^k words after the run does
if it is the first aligned one.  One that lies d < q away within the run would give the run
the periods q and d on at least q + d words, so a smaller one than q.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import focus

LEAST_LENGTH = 6
LEAST_TIMES = 4
SLICE_WORDS = 1 << 17       # words looked at together, unless one document has more


class Names:
    """Suffix array of ``text`` as deep as ``depth`` words, and names of all stretches of 2^k
    words: ``names[k][i]`` is where the suffixes that start like i's begin in the array."""

    def __init__(self, text: np.ndarray, depth: int):
        size = len(text)
        order = np.argsort(text)
        new = np.concatenate([[True], np.diff(text[order]) != 0])
        begin = np.maximum.accumulate(np.where(new, np.arange(size), 0))
        name = np.empty(size, np.int32)
        name[order] = begin
        self.array, self.names = order, [name]
        step = 1
        while step < depth:
            alone = new & np.append(new[1:], True)
            slots = np.flatnonzero(~alone)
            name = name.copy()
            if len(slots):
                at = order[slots]
                after = at + step       # the last mark is alone, so what is left has words after it
                key = name[at].astype(np.int64) * (size + 1) + np.where(after < size, name[np.minimum(after, size - 1)] + 1, 0)
                sort = np.argsort(key)
                key, order[slots] = key[sort], at[sort]
                new[slots] = np.concatenate([[True], np.diff(key) != 0])
                begin = np.maximum.accumulate(np.where(new[slots], slots, 0))
                name[order[slots]] = begin
            self.names.append(name)
            step *= 2

    def shared(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from a and b on (or, ``back``, before them) are the same."""
        size, found = len(self.array), np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            step, name = 1 << k, self.names[k]
            going = np.arange(len(a))
            while len(going):
                x, y = (v[going] - found[going] - step if back else v[going] + found[going] for v in (a, b))
                inside = (x >= 0) if back else (y + step <= size)
                going = going[inside]
                going = going[name[x[inside]] == name[y[inside]]]
                found[going] += step
                if k < len(self.names) - 1:
                    break       # a second step was a step of the level above
        return found


class WaveletMatrix:
    """Order statistics of stretches of a permutation, for many queries at once."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        for bit in range(max(1, int(len(values) - 1).bit_length()) - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[low], values[~low]])

    def below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of the values at lo..hi-1 are smaller."""
        n = np.zeros(len(lo), np.int64)
        for bit, zeros, split in self.levels:
            one = (value >> bit) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            n += np.where(one, b - a, 0)
            lo, hi = np.where(one, split + lo - a, a), np.where(one, split + hi - b, b)
        return n

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest (from 0) of the values at lo..hi-1."""
        value = np.zeros(len(lo), np.int64)
        for bit, zeros, split in self.levels:
            a, b = zeros[lo], zeros[hi]
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            value |= one.astype(np.int64) << bit
            lo, hi = np.where(one, split + lo - a, a), np.where(one, split + hi - b, b)
        return value


def runs_of(text: np.ndarray, longest: int, least_length: int = LEAST_LENGTH, times: int = LEAST_TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in ``text``, by start and period.

    ``text`` ends each document with a mark that comes once; ``longest`` is the most words of one.
    """
    names = Names(text, max(2, longest // times))
    size, wavelet, candidates = len(text), None, []
    for k in range(1, len(names.names)):
        width, name = 1 << k, names.names[k]
        block = np.arange(0, size - width + 1, width)
        lo = name[block].astype(np.int64)
        hi = lo + np.bincount(name, minlength=size)[lo]
        again = hi - lo > 1
        block, lo, hi = block[again], lo[again], hi[again]
        if not len(block):
            break       # no longer stretch comes again either
        wavelet = wavelet or WaveletMatrix(names.array)
        rank = wavelet.below(lo, hi, block)
        has = rank + 1 < hi - lo
        after = wavelet.nth(lo[has], hi[has], rank[has] + 1) - block[has]
        near = after <= width
        candidates.append((block[has][near], after[near]))
        has = rank > 0
        before = block[has] - wavelet.nth(lo[has], hi[has], rank[has] - 1)
        near = before <= width
        candidates.append((block[has][near] - before[near], before[near]))
    if not candidates:
        return (np.empty(0, np.int64),) * 3
    at, period = (np.concatenate(x) for x in zip(*candidates))
    start = at - names.shared(at, at + period, back=True)
    end = at + period + names.shared(at, at + period)
    fits = end - start >= np.maximum(least_length, times * period)
    start, end, period = start[fits], end[fits], period[fits]
    order = np.lexsort((period, end, start))        # of one stretch's periods the smallest counts
    start, end, period = start[order], end[order], period[order]
    first = np.concatenate([[True], (np.diff(start) != 0) | (np.diff(end) != 0)])[: len(start)]
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _slices(docs: list[list[bytes]], limit: int) -> list[tuple[int, int]]:
    """Stretches of documents of at most ``limit`` words together, or of one document."""
    out, first, words = [], 0, 0
    for i, doc in enumerate(docs):
        if words and words + len(doc) > limit:
            out.append((first, i))
            first, words = i, 0
        words += len(doc)
    return [*out, (first, len(docs))] if len(docs) > first else out


def _slice_runs(words: list[list[bytes]], least_length: int, times: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of each of some documents, as (start, length, period) within it."""
    n = np.array([len(w) for w in words], np.int64)
    flat = pa.array([w for doc in words for w in doc], pa.binary()).dictionary_encode()
    first = np.concatenate([[0], np.cumsum(n + 1)])
    text = np.empty(first[-1], np.int64)
    marks = first[1:] - 1
    is_word = np.ones(len(text), bool)
    is_word[marks] = False
    text[is_word] = flat.indices.to_numpy()
    text[marks] = len(flat.dictionary) + np.arange(len(words))
    start, length, period = runs_of(text, int(n.max()), least_length, times)
    of = np.searchsorted(first, start, side="right") - 1
    cut = np.searchsorted(of, np.arange(len(words) + 1))
    start = start - first[of]
    return [(start[a:b], length[a:b], period[a:b]) for a, b in zip(cut.tolist(), cut[1:].tolist())]


def collapsed(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    start, length, period = runs
    if len(start):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        words = compress(words, (np.cumsum(change)[:-1] == 0).tolist())
    return b" ".join(words)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable[[object, int], np.ndarray | None] | None = None,
              least_length: int = LEAST_LENGTH, times: int = LEAST_TIMES, slice_words: int = SLICE_WORDS) -> DataFrame:
    """id, n_words, runs (array of start, length, period in words, by start, then period) and
    the collapsed text of every whole document, in which each run is left its first period.

    A run is a stretch of words with smallest period q, of at least ``times * q`` and
    ``least_length`` words, that no neighbouring word extends.  Words are what ASCII white space
    parts.  ``rewrite(id, n)`` may give the places that the n words of a document are taken
    from instead.  A NULL or empty text has no words and no runs; repeated rows stay, a slice
    looks at equal texts once; an empty table gives no rows; other columns are left out.
    Nothing is shuffled; a slice takes about 200 bytes a word.  Runs of fewer than four
    periods need not hold a block that comes again: ``times`` below 4 raises.
    """
    if times < 4:
        raise ValueError("runs of at least four periods are found")

    def run(batches):
        focus()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words, equal, places = [], [], {}
            for i, text in zip(ids, texts):
                doc = (text or b"").split()
                taken = rewrite(i, len(doc)) if rewrite else None
                if taken is not None:
                    doc = [doc[k] for k in taken.tolist()]
                key = text if taken is None else len(equal)
                equal.append(places.setdefault(key, len(words)))
                if equal[-1] == len(words):
                    words.append(doc)
            found = []
            for a, b in _slices(words, slice_words):
                found += _slice_runs(words[a:b], least_length, times)
            short = [collapsed(w, r) for w, r in zip(words, found)]
            n = np.array([len(found[k][0]) for k in equal], np.int32)
            fields = [pa.array(np.concatenate([found[k][f] for k in equal])) for f in range(3)]
            runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(words[k]) for k in equal], pa.int64()), runs, pa.array([short[k] for k in equal], pa.binary()).cast(pa.string())],
                                             names=[id_col, "n_words", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("_text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def cycle(doc_id, n: int) -> np.ndarray | None:
    """The repetition that the contract asks for in one document of ten: places of its words."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    taken = np.arange(n)
    taken[a:] = a + (taken[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return taken


def run_digests(docs: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """doc_id, n_runs, the run with most periods (start, length, period, exponent_milli; NULL
    without one), runs_sha256 and collapsed_sha256, after ``cycle``.  A NULL id is never cycled."""
    found = find_runs(docs, rewrite=cycle, slice_words=slice_words)
    # the first of the most: runs are ordered by start and period
    top = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (found.withColumn("_top", top)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "_top.start", "_top.length", "_top.period",
                    F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
