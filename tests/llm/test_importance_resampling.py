import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from lakekit.llm import importance_resampling as ir


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def buckets_of(text):
    w = words_of(text)
    return [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs, target, percent=25):
    source, wanted = [0] * 10_000, [0] * 10_000
    for counts, texts in ((source, [t for _, t in docs]), (wanted, target)):
        for t in texts:
            for b in buckets_of(t):
                counts[b] += 1
    S, T = float(sum(source)), float(sum(wanted))
    gain = [math.floor(1000 * math.log((t + 1) * (S + 10_000) / ((s + 1) * (T + 10_000)))) for s, t in zip(source, wanted)]
    rows = []
    for i, text in docs:
        b = buckets_of(text)
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r, (_, t) in zip(rows, docs) if len(words_of(t)) >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r) for r in rows]


def table(llm, docs):
    return llm.createDataFrame([(*d, 5, 0.5, "x") for d in docs], "doc_id long, text string, rank int, score double, _tie string")


def both(llm, docs, target):
    got = ir.resample(table(llm, docs).repartition(3), llm.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in got.collect()), key=str), sorted(brute(docs, target), key=str)


def text(rnd, n, word):
    return rnd.choice([" ", ", ", "\n"]).join(rnd.choice([word, "Alpha", "beta9", "gämma", "ÉTÉ", "x-ray"]) for _ in range(n))


def test_random_documents(llm):
    rnd = random.Random(4)
    docs = [(i, text(rnd, rnd.randint(0, 60), f"w{i % 7}")) for i in range(300)]
    got, want = both(llm, docs, [text(rnd, 30, "w3") for _ in range(20)])
    assert got == want and sum(r[4] is not None for r in got) > 20


def test_odd_texts_and_repeated_rows(llm):
    long = "Lorem ipsum dolor " * 20_000
    docs = [(1, None), (2, ""), (3, "\x00.;[]"), (4, long), (None, "word " * 25), (None, "word " * 25), (6, "w " * 19), (7, "w " * 20), (7, "w " * 20), (7, "w " * 20),
            (7, "v " * 20), (9, "日本語 テキスト " * 15), (10, "KK Ñ " * 10), (11, "a" * 100_000)] + [(20 + k, "the same words " * 10) for k in range(12)]
    got, want = both(llm, docs, ["w w w", None, "", "the same words"])
    assert got == want


def test_one_row_repeated(llm):
    """A row that most of the table is made of: every copy is ranked once."""
    docs = [(5, "copy of a document " * 6)] * 400 + [(i, "another one here " * 8) for i in range(10, 30)]
    got, want = both(llm, docs, ["copy of"])
    assert got == want and sorted(r[4] for r in got if r[4] is not None) == list(range(1, 106))


def test_empty_tables(llm):
    assert both(llm, [], ["target"]) == ([], [])
    docs = [(i, f"word{i} " * 30) for i in range(8)]
    got, want = both(llm, docs, [])
    assert got == want


def test_features_in_order():
    bucket, first, n = ir.features(pa.array(["b a b", None, "", "A"]))
    want = [buckets_of(t) for t in ("b a b", None, "", "A")]
    assert [bucket[a:b].tolist() for a, b in zip(first, first[1:])] == want and n.tolist() == [3, 0, 0, 1]
    assert ir.features(pa.array([], pa.string()))[1].tolist() == [0]


def test_draw_follows_the_target(llm):
    """Documents like the target are drawn far more often than others."""
    rnd = random.Random(1)
    docs = [(i, " ".join(rnd.choice(["sun", "moon", "star"] if i % 10 == 0 else ["cat", "dog", "cow"]) for _ in range(40))) for i in range(400)]
    drawn = {r["doc_id"] for r in ir.resample(table(llm, docs), llm.createDataFrame([("sun moon star sun star " * 50,)], "text string")).collect() if r["rank"]}
    assert len(drawn) == 100 and np.mean([i in drawn for i in range(0, 400, 10)]) > 0.8
