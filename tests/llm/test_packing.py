import itertools
import math
import random
import struct
import time
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakekit.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_plan(histogram, capacity):
    used = {}
    plan = packing.plan_packing(histogram, capacity)
    for copies, pattern in plan:
        assert copies > 0 and sum(n * k for n, k in pattern.items()) <= capacity
        for n, k in pattern.items():
            used[n] = used.get(n, 0) + copies * k
    assert used == {n: c for n, c in histogram.items() if c}
    return sum(copies for copies, _ in plan)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20))
def test_plans_use_everything_once(histogram):
    assert check_plan(histogram, 40) >= math.ceil(sum(n * c for n, c in histogram.items()) / 40)


def fewest(lengths, capacity):
    """Bins needed at least, by trying all ways (few items)."""
    best = len(lengths)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= capacity and bins[i] not in bins[:i]:
                place(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1:]])
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best


def test_small_cases_are_near_the_fewest():
    rnd = random.Random(4)
    over = 0
    for _ in range(120):
        lengths = sorted((rnd.randrange(8, 60) for _ in range(rnd.randrange(2, 11))), reverse=True)
        got = check_plan({n: len([*g]) for n, g in itertools.groupby(lengths)}, 100)
        least = fewest(lengths, 100)
        assert got <= least + 1
        over += got > least
    assert over <= 12


def test_filling_leaves_least():
    rnd = random.Random(6)
    for _ in range(300):
        lengths = sorted({rnd.randrange(3, 50) for _ in range(8)}, reverse=True)
        counts = {n: rnd.randrange(1, 4) for n in lengths}
        room = rnd.randrange(5, 120)
        best = max(s for s in (sum(n * k for n, k in zip(lengths, ks)) for ks in itertools.product(*(range(counts[n] + 1) for n in lengths))) if s <= room)
        found = packing.best_filling(room, lengths, counts, nodes=10**6)
        assert all(found.count(n) <= counts[n] for n in found)
        assert sum(found) == best


def test_large_histogram_reaches_the_bound():
    rnd = random.Random(5)
    histogram = {}
    for _ in range(30_000):
        n = min(2048, int(rnd.lognormvariate(6.3, 1)) + 1)
        histogram[n] = histogram.get(n, 0) + 1
    assert check_plan(histogram, 2048) <= math.ceil(sum(n * c for n, c in histogram.items()) / 2048) * 1.002


@pytest.mark.parametrize("salt_rows", [4096, 3])
def test_documents(llm, salt_rows, monkeypatch):
    monkeypatch.setattr(packing, "SALT_ROWS", salt_rows)
    rnd = random.Random(7)
    texts = [None, "", "same text", "same text", "w " * 2047, "w " * 2048, "w " * 5000, "<|endoftext|> é"] + ["w " * rnd.randrange(900) for _ in range(200)]
    df = llm.createDataFrame([(i // 2, t, 0, 0) for i, t in enumerate(texts)], "doc_id long, text string, length int, _salt int")
    rows = packing.pack(packing.staged(packing.token_pieces(df, PATH), "test-pieces"), salt_rows=salt_rows).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at: at + 2048]
            want.append((i // 2, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(filled) <= math.ceil(sum(w[3] for w in want) / 2048) + 1


def test_empty_table_and_refused_lengths(llm):
    df = llm.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.plan_packing({0: 1})


def test_very_many_short_pieces_beside_a_long_one():
    assert packing.best_filling(1008, [1], {1: 3000}) == [1] * 1008
    assert check_plan({1040: 10_000, 1: 3000}, 2048) == 10_000


def test_small_cases_need_the_fewest():
    """Cases where bins filled by least waste alone are more than needed are among these."""
    rnd = random.Random(4)
    filled_by_waste = 0
    for _ in range(400):
        lengths = sorted((rnd.randrange(8, 60) for _ in range(rnd.randrange(2, 11))), reverse=True)
        histogram = {n: len([*g]) for n, g in itertools.groupby(lengths)}
        least = fewest(lengths, 100)
        assert packing.fewest_bins(histogram, 100) <= packing.least_bins(histogram, 100) <= least
        assert check_plan(histogram, 100) == least, lengths
        filled_by_waste += min(sum(c for c, _ in packing._plan(histogram, 100, f)) for f in (packing._greedy, packing.best_filling)) > least
    assert filled_by_waste > 0


def test_long_plans_that_miss_the_bound_end():
    """A hot length over half the capacity and thousands of others: many steps, no deep calls."""
    rnd = random.Random(8)
    histogram = {n: rnd.randrange(1, 9) for n in range(3, 2049, 3)} | {1026: 20_000, 690: 5000}
    greedy = sum(c for c, _ in packing._plan(histogram, 2048, packing._greedy))
    assert packing.fewest_bins(histogram, 2048) <= check_plan(histogram, 2048) <= greedy
    hot = {n: 40 for n in range(520, 900, 7)}
    greedy = sum(c for c, _ in packing._plan(hot, 2048, packing._greedy))
    least = packing.fewest_bins(hot, 2048)
    assert least < greedy and least <= check_plan(hot, 2048) <= greedy


@pytest.mark.parametrize("ranges", [[(700, 1000, 500, 500)], [(1, 59, 1000, 1000), (700, 999, 2000, 9000)], [(410, 512, 300, 300)], [(1025, 1100, 50, 50), (1, 1, 3, 3)]])
def test_bound_proves_plans_of_two_three_and_four_a_bin(ranges):
    """Histograms whose best-fit plan is the fewest: the bound says so, and nothing is searched."""
    rnd = random.Random(1)
    histogram = {n: rnd.randint(lo, hi) for a, b, lo, hi in ranges for n in range(a, b + 1)}
    start = time.perf_counter()
    bins = check_plan(histogram, 2048)
    assert time.perf_counter() - start < 5
    assert bins <= 1.001 * packing.least_bins(histogram, 2048) + 1
