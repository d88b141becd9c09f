import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakekit.llm import pii
from tests.llm.brute import pii_base, pii_row

TRICKY = [
    None, "", "a@b.c_d@e.f", "a@b@c.d", "x@y", "a.@b..c", "a@b.c.@d.e-f.g", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.255 1.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1112 4111111111111111", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1", "+1 (499) 555-6503", "+1", "+12 ", "+1-2", "+123456789012345678",
    "call +49 30 1234567. Or (030) 123-4567", "name (at) host (dot) org", "é🙂 a@b.cd é🙂 1.2.3.4", "mail: a@b.cd, ip 10.0.0.1", "pre@x.y 4111111111111111\n+1 499 555 6503",
    "1." * 3000, "a" * 20000, "a.b" * 5000 + "@c.d", "9 " * 3000, "1.2.3.4 " * 700, "+1 2 3 4 5 6 7 8 9 " * 300,
]


def table(llm, texts):
    return llm.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, spans string, n_email string")


def check(llm, texts):
    rows = pii.find_pii(table(llm, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want, joined = pii_row(r.doc_id, texts[r.doc_id])
        assert tuple(r)[:6] == want, (texts[r.doc_id][:80], r.spans[:200], joined[:200])
        assert {*filter(None, joined.split(","))} <= {*r.spans.split(",")}


def test_base_spans_match_python(llm):
    check(llm, TRICKY)


def test_random_texts(llm):
    rnd = random.Random(5)
    pieces = ["4111 1111 1111 1111", "+1 (499) 555-6503", "a@b.c", "10.0.0.1", "1", "2 ", "-", ".", "@", "+", "a", "é", "🙂", " ", "(", ")", "\n", "_", "%", "", "99.", "555-1234"]
    check(llm, ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(40))) for _ in range(1500)])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("a@.1 +-()é", max_size=30), min_size=1, max_size=60))
def test_property(llm, texts):
    check(llm, texts)


def test_repeated_rows_and_empty_table(llm):
    df = llm.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd"), (None, "+1 (499) 555-6503")], "doc_id long, text string")
    rows = pii.find_pii(df).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.n_phone) for r in rows) == [(0, 0, 1), (1, 1, 0), (1, 1, 0)]
    assert pii.find_pii(df.limit(0)).count() == 0


def test_loose_forms_are_added_when_the_model_trusts_them(llm):
    texts = [f"phone {k} +1 (499) 555-65{k:02d} and mail a{k}@b.org" for k in range(60)] + ["write joe (at) host (dot) org or call (499) 555-6503 now"]
    rows = {r.doc_id: r.spans for r in pii.find_pii(table(llm, texts)).collect()}
    for i, t in enumerate(texts):
        assert {f"{k}:{a}:{b}" for k, a, b in pii_base(t)} <= {*rows[i].split(",")} - {""}
    assert rows[60].startswith("email:6:")


def test_redact(llm):
    texts = ["mail a@b.cd!", "no data", None, "", "é +1 (499) 555-6503 🙂 10.0.0.1"]
    got = {r.doc_id: r.text for r in pii.redact(table(llm, texts)).collect()}
    assert got == {0: "mail [EMAIL]!", 1: "no data", 2: None, 3: "", 4: "é [PHONE] 🙂 [IP]"}
    assert pii.redact(table(llm, texts)).columns == table(llm, texts).columns


@pytest.mark.parametrize("text", ["a@b.c 10.0.0.1", "x 4111111111111111"])
def test_overlapping_spans_are_redacted_once(llm, text):
    out = pii.redact(table(llm, [text])).collect()[0].text
    assert "@" not in out and "4111" not in out and "10.0" not in out


PARTS = {
    "order 12 4111111111111111 ok": "4111111111111111", "pay 4111.1111.1111.1111 ok": "4111.1111.1111.1111", "card 3782_822463_10005": "3782_822463_10005",
    "host 999.10.0.0.1 up": "10.0.0.1", "call +1 499 555 6503 22 33 44 55 now": "+1 499 555 6503", "call +123456789012345678901": "+123456789012345",
    "host fe80::1ff:2 up": "fe80::1ff:2", "host ::1 up": "::1", "host 2001:db8:0:0:0:0:2:1 up": "2001:db8:0:0:0:0:2:1",
    "mail JOE (AT) Host (DOT) ORG": "JOE (AT) Host (DOT) ORG", "mail joe at host dot org": "joe at host dot org", "mail joe @ host.org": "joe @ host.org",
}


def test_parts_of_failing_runs_and_loose_forms_can_be_chosen(llm):
    """Learnt from a corpus of valid base matches; none of ``PARTS`` is one."""
    words = ["order", "card", "host", "call", "mail", "pay", "see 12.", ""]
    known = [f"{w} {x}" for w in words for x in ("4111111111111111", "4111 1111 1111 1111", "378282246310005", "3782 822463 10005", "10.0.0.1", "a@b.org",
                                                 "+1 499 555 6503", "+123456789012345")]
    texts = [*known, *PARTS]
    rows = {r.doc_id: r for r in pii.find_pii(table(llm, texts)).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(table(llm, texts)).collect()}
    loose = {r.doc_id: r._loose for r in pii.with_candidates(table(llm, texts)).collect()}
    for i, (text, want) in enumerate(PARTS.items(), len(known)):
        assert want in {text[s.start:s.stop] for s in loose[i]}, text
        assert tuple(rows[i])[:6] == pii_row(i, text)[0]
    for i, want in enumerate([*PARTS.values()][:2], len(known)):
        assert "card:" in rows[i].spans and want not in clean[i] and "[CARD]" in clean[i]


def test_parts_with_many_groups_keep_their_places(llm):
    """Parts of a long run are where the text has them, and only those that pass the check."""
    text = "é 🙂 " + "12 4111111111111111 " * 40 + "x " + "999.10.0.0.1 " * 40
    loose = pii.with_candidates(table(llm, [text])).collect()[0]._loose
    cards, hosts = ([(s.start, s.stop) for s in loose if s.kind == k] for k in (2, 1))
    assert {text[a:b] for a, b in hosts} == {"10.0.0.1"} and len({*hosts}) == 40
    assert len([1 for a, b in {*cards} if text[a:b] == "4111111111111111"]) == 40
    for a, b in cards:
        digits = [int(c) for c in text[a:b] if c.isdigit()][::-1]
        assert 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_words_and_code_are_no_addresses(llm):
    texts = ["std::vector a::b::c", "look at example.com now", "1::2::3", ":: x", "12:30:45", "a::b:c:d:e:f:1:2:3"]
    assert [[s for s in r._loose if s.kind in (0, 1)] for r in pii.with_candidates(table(llm, texts)).collect()] == [[]] * len(texts)


DECOYS = ["we met at noon dot dot yesterday", "look at home dot page now", "see me at the dot com boom", "serial 100-200-3000 part", "the order 555-867-5309 was sent",
          "std::vector a::b::c", "chapter 1::2 of it", "stay at work dot it is late", "go to example.com at once", "tracking 12 9999999999999995 left", "rows 1.2.3 of 4",
          "hash 1234567890123456789012345678901234567890 done", "part 212.555.0143 is out", "he is good at chess dot matrix printers too", "a=499-555-6503"]
HIDDEN = {"mail joe (at) host (dot) org now": "joe (at) host (dot) org", "please write to ann.lee [at] firm [dot] com": "ann.lee [at] firm [dot] com", "my e-mail: bob (at) site.net": "bob (at) site.net",
          "call (499) 555-6503 now": "(499) 555-6503", "my phone 212-555-0143": "212-555-0143", "visa 12 4111111111111111 ok": "4111111111111111",
          "pay 4111.1111.1111.1111 ok": "4111.1111.1111.1111", "order 12 4111111111111111 ok": "4111111111111111", "host 2001:db8:0:0:0:0:2:1 up": "2001:db8:0:0:0:0:2:1",
          "contact eve at shop dot com": "eve at shop dot com", "server 999.10.0.0.1 up": "10.0.0.1"}


@pytest.mark.parametrize("corpus", ["none", "base only", "prose and numbers"])
def test_prose_is_left_alone_and_hidden_data_found(llm, corpus):
    """Whatever the corpus shows: plain base matches alone must not make the model accept prose."""
    base = [f"{w} {x} end {k}" for k in range(8) for w in ("see", "mail", "host", "call", "pay") for x in ("a@b.org", "10.0.0.1", "4111111111111111", "+1 499 555 6503", "999.1.1.1.1", "+12")]
    prose = [f"{k} met at noon dot dot and serial {100 + k}-200-3000 at number {k}" for k in range(40)]
    known = {"none": [], "base only": base, "prose and numbers": base + prose}[corpus]
    texts = [*known, *DECOYS, *HIDDEN]
    spans = {r.doc_id: r.spans for r in pii.find_pii(table(llm, texts)).collect()}
    wrong = {t: spans[i] for i, t in enumerate(DECOYS, len(known)) if spans[i]}
    assert not wrong
    missed = [t for i, (t, want) in enumerate(HIDDEN.items(), len(known) + len(DECOYS))
              if not any(t[int(a):int(b)] == want for _, a, b in (s.split(":") for s in spans[i].split(",") if s))]
    assert not missed


def test_no_column_is_overwritten_or_clashes(llm):
    """Columns with any of the names that are used inside come through as they are."""
    names = ["_clean", "_digit", "_base", "_loose", "_valid", "_found", "_added", "_spans", "_row", "_text", "_fold", "_id", "_base_email", "_part_0", "spans", "kind"]
    df = llm.createDataFrame([("mail a@b.cd now", *(f"keep {n} a@b.cd" for n in names), {"k": 1})], ", ".join(f"`{c}` string" for c in ["text", *names]) + ", m map<string,int>")
    out = pii.redact(df)
    assert out.columns == df.columns and out.collect()[0].asDict() == {"text": "mail [EMAIL] now", **{n: f"keep {n} a@b.cd" for n in names}, "m": {"k": 1}}
    found = pii.find_pii(df.withColumn("doc_id", F.lit(1))).collect()[0]
    assert found.n_email == 1 and found.spans == "email:5:11"
    with pytest.raises(ValueError, match="used here"):
        pii.with_candidates(df)
