import random
import re

import numpy as np
import pytest

from lakekit.llm import jaccard_join as jj
from lakekit.llm.components import connected
from tests.llm.brute import components, jaccard_components, shingles


def run(llm, rows, **options):
    df = llm.createDataFrame([(i, t, -1, "z") for i, t in rows], "doc_id long, text string, component_id int, print string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(df, **options).collect()}


def near_copies(rnd, groups, size):
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(*size))]
        texts.append(base)
        for _ in range(rnd.randrange(6)):
            copy = list(rnd.choice(texts[-3:]))
            for _ in range(rnd.randrange(1 + len(copy) // 25)):
                k = rnd.randrange(len(copy))
                copy[k:k + 1] = rnd.choice([[], [rnd.choice(vocabulary)], [copy[k], "plus"]])
            texts.append(copy)
    rnd.shuffle(texts)
    return [(i * 3 + 1, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size", [(4, 30), (20, 120), (100, 400)])
def test_against_brute_force(llm, size):
    rows = near_copies(random.Random(size[1]), 45, size)
    assert run(llm, rows) == jaccard_components(rows)


@pytest.mark.parametrize("size", [(4, 60), (60, 200)])
def test_five_words_and_four_fifths(llm, size):
    rows = near_copies(random.Random(size[1] + 1), 40, size)
    assert run(llm, rows, words=5, percent=80) == jaccard_components(rows, 80, 5)


def test_chain_of_links_is_one_component(llm):
    words = [f"w{i}" for i in range(300)]
    rows = [(100 - k, " ".join(words[k * 5: k * 5 + 200])) for k in range(20)]
    want = jaccard_components(rows)
    assert len({c for _, c in want.values()}) == 1
    assert run(llm, rows) == want


def test_small_blocks_give_the_same(llm, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_GRAMS", 500)
    rows = near_copies(random.Random(9), 40, (40, 80))
    assert run(llm, rows) == jaccard_components(rows)


def test_edges(llm):
    rows = [(5, None), (4, ""), (3, " \n\t"), (2, "One two"), (7, "one TWO"), (9, "one two three"), (8, "ONE\x0btwo\r\nthree"), (11, "É two three"), (12, "é two three"),
            (20, "a b c " * 5000), (21, "a b c " * 100), (30, "\xa0x"), (31, "x")]
    assert run(llm, rows) == jaccard_components(rows)


def test_null_ids_repeated_rows_and_empty_table(llm):
    df = llm.createDataFrame([(None, "a b c d"), (2, "a b c d"), (1, "a b c d"), (1, "a b c d"), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()), key=str)
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (None, 2, None)]
    assert jj.jaccard_components(df.limit(0)).count() == 0


def test_an_id_with_and_without_words(llm):
    """A row without words is its own component, also where its id has another text that links."""
    words = [f"v{i}" for i in range(120)]
    rows = [(1, " ".join(words)), (1, None), (1, " \n"), (4, " ".join(words[:-1])), (4, ""), (7, " ".join(words[60:]))]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect())
    assert got == [(1, 0, 1), (1, 0, 1), (1, 118, 1), (4, 0, 4), (4, 117, 1), (7, 58, 7)]


@pytest.mark.parametrize("percent", [90, 80, 50])
def test_alike_sets_share_a_digest(percent):
    rnd = np.random.default_rng(1)
    for n in [*range(1, 60), 150, 400, 1100]:
        for _ in range(12):
            a = np.sort(rnd.integers(-2**62, 2**62, n))
            drop, add = rnd.integers(0, (n * (100 - percent)) // 80 + 2), rnd.integers(0, (n * (100 - percent)) // 80 + 2)
            b = np.sort(np.concatenate([rnd.permutation(a)[drop:], rnd.integers(-2**62, 2**62, add)]))
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
                (of_a, need_a), (of_b, need_b) = jj.part_digests(a, percent), jj.part_digests(b, percent)
                assert len(np.intersect1d(of_a, of_b)) >= max(need_a, need_b) >= 1


@pytest.mark.parametrize("heap", [0, 10**9])
def test_search_finds_all_alike_sets(monkeypatch, heap):
    monkeypatch.setattr(jj, "HEAP_POSTINGS", heap)
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 2**62, 60)
    sets = [np.unique(np.concatenate([rnd.permutation(base)[: rnd.integers(40, 61)], rnd.integers(0, 2**62, rnd.integers(0, 6))])) for _ in range(80)]
    index = jj.InvertedIndex(np.arange(80), sets)
    for q in sets:
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 90 * len(np.union1d(q, s))]
        assert sorted(index.search(q, 90)) == want


def test_gram_hashes_follow_the_words():
    texts = ["a b c d a b c", "A B  c", "a b", "b a", "a", "a b c"]
    for t in texts:
        assert len(jj.gram_set(t)) == len(shingles(t))
    assert len(np.intersect1d(jj.gram_set("a b"), jj.gram_set("b a"))) == 0


def test_components(llm):
    rnd = random.Random(3)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(100)]
    got = {r.id: r.component for r in connected(llm.createDataFrame(links, "a long, b long")).collect()}
    ids = {x for l in links if l[0] != l[1] for x in l}
    want = components(ids, [l for l in links if l[0] != l[1]])
    assert got == want
    assert connected(llm.createDataFrame([], "a long, b long")).count() == 0


def test_digests_travel_as_a_bucket_and_32_bits():
    """Equal digests of two batches meet under one part, whether a batch holds them once or often."""
    rnd = np.random.default_rng(6)
    shared, alone = rnd.integers(-2**63, 2**63 - 1, 40), rnd.integers(-2**63, 2**63 - 1, 40)
    one, here = jj._bucketed([shared, alone, shared], [7, 8, 5], 9)
    two, _ = jj._bucketed([shared], [3], 9)
    parts = [{(bucket, int(t)) for bucket, tags, _ in dealt for t in tags} for dealt in (one, two)]
    assert all(tags.dtype == np.int32 for _, tags, _ in one) and len(parts[0]) == 80
    assert parts[1] < parts[0] and len(parts[1]) == 40
    assert {(int(p) >> 32, int(np.uint32(int(p) & 0xFFFFFFFF).view(np.int32))) for p in here[0]} == parts[1]
    assert len(here[0]) == 80 and set(here[1]) == {5, 7} and set(here[2]) == {5}
    assert jj._bucketed([], [], 9)[0] == []


def _above(lines, i, *names):
    """The nearest operator above line ``i`` of a plan's text that has one of the names."""
    depth = lambda line: re.search(r"^[ :+-]*", line).end()
    here = depth(lines[i])
    for line in lines[i::-1]:
        if depth(line) < here:
            here = depth(line)
            if any(n in line for n in names):
                return line


def test_sets_and_meets_move_once(llm, monkeypatch):
    """What is small moves to the sets and the meets, however large it is for a broadcast."""
    plans = {}

    def staged(df, name, *options, write):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name, *options)

    for fn in ("staged", "staged_by"):
        if hasattr(jj, fn):
            monkeypatch.setattr(jj, fn, lambda *a, write=getattr(jj, fn): staged(*a, write=write))
    monkeypatch.setattr(jj, "TABLE_GRAMS", 2000, raising=False)
    before = llm.conf.get("spark.sql.autoBroadcastJoinThreshold")
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = llm.catalog.listTables()
    try:
        rows = near_copies(random.Random(5), 40, (60, 120))
        assert run(llm, rows, words=5, percent=80) == jaccard_components(rows, 80, 5)
    finally:
        llm.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan in plans["jaccard-links"]:
        lines = plan.splitlines()
        scans = [i for i, line in enumerate(lines) if "FileScan" in line and "grams" in line]
        assert len(scans) == 2
        assert ["Join" in _above(lines, i, "Exchange", "Join") for i in scans] == [True, True]
    assert llm.catalog.listTables() == tables       # nothing stays in the catalog


def test_small_tables_are_few_files(llm, monkeypatch):
    """However many shuffle partitions there are, as many tasks write a small table as there are cores at most."""
    from lakekit.llm import components as cc

    files, cores = {}, llm.sparkContext.defaultParallelism

    def kept(df, name, *options, write):
        table = write(df, name, *options)
        files.setdefault(name, []).append(len(table.inputFiles()))
        return table

    monkeypatch.setattr(jj, "staged", lambda *a, write=jj.staged: kept(*a, write=write))
    monkeypatch.setattr(jj, "staged_by", lambda *a, write=jj.staged_by: kept(*a, write=write))
    monkeypatch.setattr(cc, "staged", lambda *a, write=cc.staged: kept(*a, write=write))
    conf = {"spark.sql.shuffle.partitions": str(4 * cores), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: llm.conf.get(k) for k in conf}
    rows = near_copies(random.Random(12), 30 * cores // 2, (20, 60))
    try:
        for k, v in conf.items():
            llm.conf.set(k, v)
        assert run(llm, rows) == jaccard_components(rows)
    finally:
        for k, v in before.items():
            llm.conf.set(k, v)
    files["jaccard-meets"].pop(0)       # (those come in buckets)
    small = ["jaccard-distinct", "jaccard-needs", "jaccard-meets", "jaccard-wanted", "jaccard-chosen", "search-i", "search-q", "links", "labels", "jaccard-changed"]
    assert {name: max(files[name]) for name in small if max(files[name]) > cores} == {}


def test_a_search_moves_no_more_grams_at_a_time_than_there_are(llm, monkeypatch):
    """However many blocks a set is sent to, slices of the tasks keep the shuffle files of a search bounded."""
    rnd = np.random.default_rng(8)
    base = [int(x) for x in rnd.integers(0, 2**62, 60)]
    grams = {k: sorted([*base[k % 3 * 4:], *(int(x) for x in rnd.integers(0, 2**62, k % 2 * 30))]) for k in range(12)}
    sets = llm.createDataFrame([(k, len(v), v) for k, v in grams.items()], "id long, n long, grams array<long>")
    asked = llm.createDataFrame([(b, k) for b in range(8) for k in grams], "block long, id long")
    total, written = sum(map(len, grams.values())), []

    def staged(df, name, *options, write=jj.staged):
        written.append(name)
        return write(df, name, *options)

    def found(least):
        written.clear()
        monkeypatch.setattr(jj, "SLICE_GRAMS", least, raising=False)
        links = jj._search(asked, asked, sets, sets.select("id", "n"), 80, 96, total).distinct().collect()
        return {(r.a, r.b) for r in links}

    monkeypatch.setattr(jj, "staged", staged)
    whole = found(10**9)
    assert written.count("jaccard-links") == 1 and whole
    assert found(1) == whole
    assert written.count("jaccard-links") == 16       # each set goes to 8 blocks, as index and as query


def test_sets_of_one_component_are_not_sent_to_each_other(llm, monkeypatch):
    """Members of a group that are linked to each other but not to its smallest id aren't asked for where only they are indexed."""
    common, own, other = ([f"{x}{i}" for i in range(n)] for x, n in (("c", 150), ("u", 50), ("v", 50)))
    rows = [(1, " ".join(common + own)), (2, " ".join(common + other)), (3, " ".join([*common, *other[:-1], "x"])), (4, " ".join([*common, *other[:-2], "y", "z"]))]
    asked = []

    def search(index, queries, *options, of=jj._search):
        asked.append({r.id for r in queries.select("id").distinct().collect()})
        return of(index, queries, *options)

    monkeypatch.setattr(jj, "_search", search)
    assert run(llm, rows, words=5, percent=80) == jaccard_components(rows, 80, 5)
    assert len(asked) == 3 and asked[-1] == {1}
