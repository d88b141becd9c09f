import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from lakekit.llm import token_files as tf
from lakekit.llm.queries import QUERIES, WORD_BPE

COLUMNS = "doc_id long, text string, _id int, _ids string, start long, path string"


def docs(llm, rows):
    return llm.createDataFrame([(*r, 1, "x", 5, "/x") for r in rows], COLUMNS)


def library(rows):
    """(doc_id, ids) as the library encodes them, in the order of the files."""
    t = Tokenizer.from_file(WORD_BPE)
    return [(i, t.encode(text or "", add_special_tokens=False).ids + [2]) for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]


def digests(encoded):
    out, at = [], 0
    for i, ids in encoded:
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_odd_texts(llm):
    rows = [(9, "Zwölf Boxkämpfer 🙂"), (3, None), (4, ""), (1, "a  b\n\tc <|endoftext|> d"), (None, "no id"), (-5, "x" * 3000), (7, "word " * 30_000), (2, "\x00\x1c")]
    assert ordered(tf.round_trip(docs(llm, rows), WORD_BPE)) == digests(library(rows))


def test_small_files_many_parts(llm, monkeypatch):
    monkeypatch.setattr(tf, "LEAST_BYTES", 500)
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "Ünder", "42", "x,y"]) for _ in range(rnd.randint(0, 40)))) for i in rnd.sample(range(10_000), 400)]
    manifest = tf.write_token_files(docs(llm, rows).repartition(7), WORD_BPE, file_tokens=700, file_docs=19)
    files = manifest.orderBy("first_token").collect()
    assert len(files) > 10 and all(f["docs"] <= 19 for f in files) and {f["dtype"] for f in files} == {"<u2"}
    assert all(f["tokens"] <= 700 or f["docs"] == 1 for f in files)
    encoded = library(rows)
    assert ordered(tf.token_file_digests(manifest)) == digests(encoded)
    got = sorted(tf.read_token_files(manifest).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["ids"]) for r in got] == encoded
    at_docs = at_tokens = 0
    for f in files:     # bases are prefix sums, and the flat files hold nothing but ids and offsets
        assert (f["first_doc"], f["first_token"]) == (at_docs, at_tokens)
        opened = tf.TokenFile(f["path"], f["dtype"])
        flat = [i for _, ids in encoded[at_docs: at_docs + f["docs"]] for i in ids]
        assert opened.flat.tolist() == flat and len(opened.offsets) == f["docs"] + 1
        assert opened.offsets[0] == at_tokens and opened.offsets[-1] == at_tokens + f["tokens"]
        assert opened.tokens(at_tokens, at_tokens + 1).tolist() == flat[:1]
        at_docs, at_tokens = at_docs + f["docs"], at_tokens + f["tokens"]


def test_one_id_of_most_rows(llm, monkeypatch):
    """Rows of one id are spread over tasks and files, next to each other."""
    monkeypatch.setattr(tf, "LEAST_BYTES", 500)
    rows = [(5, f"copy {k % 3}") for k in range(300)] + [(5, "the same")] * 300 + [(1, "first"), (9, "last")]
    manifest = tf.write_token_files(docs(llm, rows).repartition(5), WORD_BPE, file_tokens=500)
    got = ordered(tf.token_file_digests(manifest))
    assert manifest.select("part").distinct().count() > 3 and [r[0] for r in got] == [1] + [5] * 600 + [9]
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in digests(library(rows)))
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:])) and got[0][1] == 0


def test_readers_take_some_documents_at_a_time(llm, monkeypatch):
    rows = [(i, "some words " * (i % 50)) for i in range(200)]
    manifest = tf.write_token_files(docs(llm, rows), WORD_BPE)
    monkeypatch.setattr(tf, "READ_TOKENS", 37)
    read = [(i, tokens[places[k] - places[0]: places[k + 1] - places[0]].tolist())
            for f in manifest.orderBy("first_token").collect() for ids, places, tokens in tf.TokenFile(f["path"], f["dtype"]).documents() for k, i in enumerate(ids.to_pylist())]
    assert read == library(rows)


def test_wide_vocabularies_take_four_bytes():
    assert tf.id_type(1 << 16) == np.dtype("<u2") and tf.id_type((1 << 16) + 1) == np.dtype("<u4")


def test_empty_table(llm):
    got = tf.round_trip(docs(llm, []), WORD_BPE)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.collect() == []


def test_other_kinds_of_id(llm):
    df = llm.createDataFrame([("b", "two"), ("a", "one"), (None, "none")], "doc_id string, text string")
    assert [r[0] for r in ordered(tf.round_trip(df, WORD_BPE))] == [None, "a", "b"]


def test_query_equals_the_library(llm):
    rows = [tuple(r) for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert ordered(QUERIES["op11_token_files"](llm, "/root/testdata/sf0.001")) == digests(library(rows))
