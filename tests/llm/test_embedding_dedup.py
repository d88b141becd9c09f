import numpy as np
import pytest

from lakekit.llm import embedding_dedup as ed
from tests.llm.brute import components


def brute(rows, cosine=0.93):
    units = {k: (label, ed.unit(v)) for k, (_, v, label) in enumerate(rows)}
    links = [(a, b) for a in units for b in units if a < b and None not in (units[a][0], units[b][0]) and units[a][1] is not None and units[b][1] is not None
             and units[a][0] == units[b][0] and len(units[a][1]) == len(units[b][1]) and units[a][1] @ units[b][1] >= cosine]
    ids = [r[0] for r in rows]
    comp = components(ids, [(ids[a], ids[b]) for a, b in links])
    n = {k: 0 for k in units}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {ids[k]: (n[k], comp[ids[k]], comp[ids[k]] == ids[k]) for k in units}


def run(llm, rows):
    df = llm.createDataFrame([(*r, "u", 3) for r in rows], "vec_id long, embedding array<float>, label int, unit string, cell int")
    got = ed.near_duplicates(df).collect()
    assert len(got) == len(rows)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}


def clustered(seed, n, dim=12, labels=2):
    rnd = np.random.default_rng(seed)
    out = []
    centre = rnd.normal(size=(n // 12, dim))
    for i in range(n):
        v = centre[rnd.integers(len(centre))] + rnd.normal(size=dim) * rnd.choice([0.02, 0.25, 0.5])
        out.append((i * 7 % 10007, np.float32(v).tolist(), int(rnd.integers(labels))))
    return out


@pytest.mark.parametrize("cell_rows", [2048, 24])
def test_against_brute_force(llm, monkeypatch, cell_rows):
    monkeypatch.setattr(ed, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(ed, "BLOCK", 20)
    monkeypatch.setattr(ed, "ASSIGN_ROWS", 50)
    rows = clustered(cell_rows, 400)
    assert run(llm, rows) == brute(rows)


def test_group_of_near_copies_is_counted_not_multiplied(llm, monkeypatch):
    monkeypatch.setattr(ed, "CELL_ROWS", 30)
    monkeypatch.setattr(ed, "BLOCK", 25)
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=16)
    rows = [(i, np.float32(base + rnd.normal(size=16) * (0.02 if i % 4 else 0.3)).tolist(), 1) for i in range(200)]
    rows += [(1000 + i, np.float32(rnd.normal(size=16)).tolist(), 1) for i in range(100)]
    assert run(llm, rows) == brute(rows)


def test_edges(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, -0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1),
            (9, [1.0, None], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1), (12, [1.0, 0.0, 0.0], 1), (13, [1e-30, 0.0], 1), (14, [-1.0, 0.0], 1), (15, [3e38, 3e38], 1), (16, [1.0, 1.0], 1)]
    assert run(llm, rows) == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(llm):
    df = llm.createDataFrame([(None, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1), (2, [2.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.near_duplicates(df).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, True)]
    assert ed.near_duplicates(df.limit(0)).count() == 0


def test_visits_lose_no_pair():
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(300, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = ed.spherical_kmeans(x, 9)
    near, own = x @ c.T, (x @ c.T).argmax(1)
    sine = np.sqrt(1 - 0.93 ** 2)
    for a, b in np.argwhere(x @ x.T >= 0.93):
        if own[a] < own[b]:
            k, d = own[a], own[b]
            assert near[a, k] - near[a, d] <= sine * np.linalg.norm(c[k] - c[d]) + 1e-9
