import random

from lakekit.llm import host_rules
from tests.llm.brute import host_measures

TRICKY = [None, "", " \n\t", "one", "a b c d e a b c d e", "a b c d e f " * 9, "w " * 500, "x\ny\nx\n \n \nx", "#*$%&|<> a#b", "é🙂 ñ\x0bq\x0cr\rs",
          "a b c d e x a b c d e y b c d e x", " lead trail ", "\xa0 nbsp\x1cfs", "a b a b a b a b a b a b", "k " * 30000]


def check(llm, texts):
    df = llm.createDataFrame([(i, t, "h", 1, True) for i, t in enumerate(texts)], "doc_id long, text string, source string, n_words int, kept boolean")
    got = {r.doc_id: tuple(r)[1:7] for r in host_rules.judge_documents(df).collect()}
    assert got == {i: host_measures(t) for i, t in enumerate(texts)}


def test_measures(llm):
    check(llm, TRICKY)


def test_random_measures(llm):
    rnd = random.Random(2)
    check(llm, ["".join(rnd.choice(["a", "b", "c", " ", " ", "\n", "#", "\t", "é"]) for _ in range(rnd.randrange(160))) for _ in range(600)])


def test_bad_host_takes_its_documents_along(llm):
    good = "these are twelve quite different words in one plain honest little text"
    rows = [(i, good, f"h{i % 40}") for i in range(800)] + [(1000 + i, "short", "bad") for i in range(60)] + [(2000, good, "bad"), (2001, good, None), (2002, None, None)]
    kept = {r.doc_id: r.kept for r in host_rules.judge_documents(llm.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(kept[i] for i in range(800))
    assert not kept[1000] and not kept[2000] and kept[2001] and not kept[2002]


def test_small_host_is_shrunk_towards_the_rest(llm):
    good = "these are twelve quite different words in one plain honest little text"
    rows = [(i, good if i % 10 else "short", f"h{i % 41}") for i in range(1640)] + [(5000, "short", "tiny"), (5001, good, "tiny")]
    kept = {r.doc_id: r.kept for r in host_rules.judge_documents(llm.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert kept[5001] and not kept[5000]


def test_empty_table_and_repeated_rows(llm):
    df = llm.createDataFrame([(1, "a", "s"), (1, "a", "s")], "doc_id long, text string, source string")
    assert host_rules.judge_documents(df).count() == 2
    assert host_rules.judge_documents(df.limit(0)).count() == 0
