import hashlib
import re
import struct
import zlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from lakekit.llm.common import staged
from tests.llm.brute import jaccard_components, pii_base

SF = "/root/testdata/sf0.001"


def stages(llm, docs, sf_dir):
    out = []
    for name, stage in cp.STAGES:
        docs = staged(stage(llm, docs, sf_dir), f"test-{name}")
        out.append(docs)
    return out


def test_stages_against_plain_versions(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    known, good, unique, clean, packed = stages(llm, docs, SF)
    assert known.columns == good.columns == unique.columns == clean.columns == docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in known.collect()}
    assert all(re.search(r"[^\W\d_]", rows[i]) for i in kept)
    labels = {r.doc_id: r.quality for r in llm.read.parquet(f"{SF}/labels.parquet").collect()}
    passed = {r.doc_id: r.text for r in good.collect()}
    assert len({i for i in kept if labels.get(i) == 1} - {*passed}) <= 0.02 * len(kept)
    component = jaccard_components(sorted(passed.items()), 80, 5)
    left = {r.doc_id: r.text for r in unique.collect()}
    assert left == {i: t for i, t in passed.items() if component[i][1] == i}
    redacted = {r.doc_id: r.text for r in clean.collect()}
    assert {*redacted} == {*left}
    for i, text in redacted.items():
        assert (text == left[i]) == (not pii_base(left[i]))
        assert not pii_base(text)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packed.collect()
    assert {r.doc_id for r in pieces} == {*redacted}
    filled = {}
    for r in pieces:
        ids = tokenizer.encode(redacted[r.doc_id], add_special_tokens=False).ids + [0]
        part = ids[r.start: r.start + r.length]
        assert r.start == r.piece * 2048 and r.length == min(2048, len(ids) - r.start)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_is_the_stages_in_turn(llm):
    rows = cp.run(llm, SF)
    assert rows.count() > 0
    assert hashlib.sha256(",".join(rows.columns).encode()).hexdigest() == hashlib.sha256(b"doc_id,piece,start,length,ids_crc32,sequence_id,offset").hexdigest()


def test_odd_rows(llm):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, _id long"
    text = "these are words of a text that goes on for a while and then it ends"
    rows = [(1, text, "en", "s", 5, 0.1, 1), (1, text, "en", "s", 5, 0.1, 1), (2, text, "en", None, None, None, None), (3, None, None, None, None, None, None),
            (4, "", "en", "s", 0, 0.0, 0), (None, text, "en", "s", 5, 0.1, 1), (5, "12 34", "de", "s", 5, 0.1, 1), (6, "mail a@b.cd and " + text.replace("text", "long letter"), "en", "s", 1, 0.0, 0)]
    known, good, unique, clean, packed = stages(llm, llm.createDataFrame(rows, schema), SF)
    assert sorted(r.doc_id or 0 for r in known.collect()) == [0, 1, 1, 2, 6]
    assert sorted(r.doc_id or 0 for r in unique.collect()) == [0, 1, 6]
    assert {r.doc_id: r.text for r in clean.collect()}[6] == "mail [EMAIL] and " + text.replace("text", "long letter")
    assert packed.count() == 3


def test_empty_table(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert [d.count() for d in stages(llm, docs, SF)] == [0] * 5


def test_different_texts_of_one_id_stay_and_names_do_not_clash(llm):
    """Each stage hands on columns of any name and type as they are."""
    names = ["_row", "_text", "_partition", "_quality", "_lang_pred", "_lang_score", "_clean", "_base", "_loose", "_q_words", "component_id", "score"]
    a = "these are the words of a first text that goes on for a while and then comes to its end"
    b = "another story is told here about people in towns who walk to the river and see the boats"
    base = [(1, a), (1, a), (1, b), (2, a), (3, b + " mail a@b.cd")]
    rows = [(i, t, "en", "s", 5, {"k": 1}, *(f"keep {n}" for n in names)) for i, t in base]
    schema = "doc_id long, text string, lang string, source string, n_chars long, m map<string,int>, " + ", ".join(f"`{n}` string" for n in names)
    docs = llm.createDataFrame(rows, schema)
    for name, stage in cp.STAGES[:-1]:
        out = stage(llm, docs, SF)
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r[n] == f"keep {n}" for r in got for n in names) and all(r.m == {"k": 1} for r in got), name
        if name == "near_duplicates":
            assert sorted((r.doc_id, r.text) for r in got) == sorted({(1, a), (1, b)})
