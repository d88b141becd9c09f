import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lakekit.llm import periodic_runs as pr


def brute_runs(words, least=6, times=4):
    """All runs by comparing the words with themselves, shifted by each period."""
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)     # the smallest period of the stretch
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def random_words(rnd, n):
    letters = rnd.choice([1, 2, 3, 5, 40])
    words = [b"w%d" % rnd.randrange(letters) for _ in range(n)]
    if n and rnd.random() < 0.7:
        s, p = rnd.randrange(n), 1 + rnd.randrange(max(1, n // 4))
        for i in range(s, min(n, s + p * rnd.randint(3, 9))):
            words[i] = words[s + (i - s) % p]
        if rnd.random() < 0.3:
            words[rnd.randrange(n)] = b"zz"
    return words


def test_random_slices_equal_brute_force():
    rnd = random.Random(5)
    for _ in range(400):
        docs = [random_words(rnd, rnd.randint(0, 130)) for _ in range(rnd.randint(1, 5))]
        for words, got in zip(docs, pr._slice_runs(docs, 6, 4)):
            assert list(zip(*(x.tolist() for x in got))) == brute_runs(words)


def test_fewer_than_four_periods_raise(llm):
    with pytest.raises(ValueError):
        pr.find_runs(llm.createDataFrame([], "doc_id long, text string"), times=3)


@pytest.mark.parametrize("least,times", [(2, 4), (10, 5), (30, 6)])
def test_other_limits(least, times):
    rnd = random.Random(times)
    for _ in range(100):
        words = random_words(rnd, rnd.randint(0, 100))
        got, = pr._slice_runs([words], least, times)
        assert list(zip(*(x.tolist() for x in got))) == brute_runs(words, least, times)


def test_every_period_and_place():
    """One run of each period and length around the limits, at every alignment."""
    for q in range(1, 19):
        for extra in (-1, 0, 1, q):
            for before in range(0, 40, 3):
                n = max(6, 4 * q) + extra
                words = [f"b{i}".encode() for i in range(before)] + [f"w{i % q}".encode() for i in range(n)] + [b"end"]
                got, = pr._slice_runs([words], 6, 4)
                assert list(zip(*(x.tolist() for x in got))) == ([(before, n, q)] if extra >= 0 else [])


def test_wavelet_matrix_against_sorting():
    rnd = np.random.default_rng(2)
    for size in (1, 2, 3, 17, 200):
        values = rnd.permutation(size)
        w = pr.WaveletMatrix(values)
        lo = rnd.integers(0, size, 50)
        hi = lo + 1 + (rnd.integers(0, size, 50) % (size - lo))
        at = rnd.integers(0, size, 50)
        assert w.below(lo, hi, at).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(lo, hi, at)]
        n = at % (hi - lo)
        assert w.nth(lo, hi, n).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(lo, hi, n)]


def test_digests_equal_brute_force(llm):
    rnd = random.Random(8)
    rows = [(i, " ".join(w.decode() for w in random_words(rnd, rnd.randint(0, 150)))) for i in range(250)]
    rows += [(None, "a a a a a a a"), (1000, None), (1001, ""), (1002, " \t\n"), (1003, "ü é ü é ü é ü é\x0bü"), (1004, "x y " * 8), (1005, "one"),
             (1006, "a " * 5000), (1007, " ".join(f"w{i % 700}" for i in range(4000))), (3, rows[3][1]), (3, rows[3][1]), (3, "b " * 9)]
    df = llm.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, runs int, _text string").repartition(3)
    got = sorted((tuple(r) for r in pr.run_digests(df, slice_words=900).collect()), key=str)
    assert got == sorted((brute_row(*r) for r in rows), key=str)
    assert any(r[1] for r in got) and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0])


def test_runs_and_texts_come_back(llm):
    df = llm.createDataFrame([(1, "start " + "la li " * 6 + "end")], "doc_id long, text string")
    row = pr.find_runs(df).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 12, 2)] and row["n_words"] == 14 and row["collapsed"] == "start la li end"


def test_empty_table(llm):
    got = pr.run_digests(llm.createDataFrame([], "doc_id long, text string"))
    assert got.collect() == [] and got.columns[:3] == ["doc_id", "n_runs", "start"]
