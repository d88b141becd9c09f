import hashlib
import io
import random
import struct
import zipfile

import pytest

from lakekit.llm import warc

HTML = "<html>" + "x" * 200


def pages(llm, rows):
    return llm.createDataFrame([(*r, "digest", 1) for r in rows], "page_id long, url string, html string, digest string, payload_bytes int")


def expected(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data) if first.get(data) != i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def test_round_trip(llm):
    rows = [(3, "http://a/", HTML), (1, "http://b/ c\n", HTML), (2, None, HTML), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
            (8, "u", "é🙂\r\n\r\nWARC/1.1\r\n" * 20), (9, "u", "é" * 50), (10, "u", "é" * 50), (11, "u", "z" * 300_000), (None, "u", "q" * 100), (None, "u", HTML)]
    got = sorted((tuple(r) for r in warc.round_trip(pages(llm, rows)).collect()), key=str)
    assert got == expected(rows)


def test_random_round_trip_with_small_archives(llm):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab<é\r\n") for _ in range(rnd.randrange(150))) for _ in range(40)]
    rows = [(i, f"http://{i}", rnd.choice(texts)) for i in range(400)]
    listing = warc.write_archives(pages(llm, rows), limit=2000)
    assert listing.count() > 5
    back = warc.read_archives(listing).collect()
    assert sorted((tuple(r[f] for f in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in back), key=str) == expected(rows)
    by_id = {r.page_id: r for r in back}
    for i, url, html in rows:
        r = by_id[i]
        assert r.url == url
        assert bytes((r if r.record_type == "response" else by_id[r.refers_to]).payload) == html.encode()


def test_repeated_rows_and_empty_table(llm):
    rows = [(1, "u", HTML), (1, "u", HTML), (2, "u", HTML)]
    got = sorted((r.page_id, r.record_type) for r in warc.round_trip(pages(llm, rows)).collect())
    assert got == [(1, "response"), (1, "response"), (2, "revisit")]
    assert warc.round_trip(pages(llm, [])).count() == 0


def zipped(members, **options):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", **options) as z:
        for name, data in members.items():
            z.writestr(name, data)
        z.comment = b"a comment with PK\x05\x06 in it"
    return out


@pytest.mark.parametrize("limit", [zipfile.ZIP64_LIMIT, 10])
def test_directories_zip_and_zip64(monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    data = {f"é{i}.bin": bytes([i]) * (50 + i) for i in range(30)}
    f = zipped(data)
    found = warc.zip_members(f, len(f.getvalue()))
    assert set(found) == set(data)
    for name, want in data.items():
        start, size = warc.stored_member(f, found[name])
        assert warc.read_range(f, start, size) == want


def test_compressed_member_and_damage_are_refused():
    f = zipped({"a": b"x" * 500}, compression=zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError):
        warc.stored_member(f, warc.zip_members(f, len(f.getvalue()))["a"])
    with pytest.raises(ValueError):
        warc.zip_members(io.BytesIO(b"no zip at all" * 10), 130)
    assert struct.calcsize("<HII") == 10


def test_archives_are_valid_zip_files(llm, tmp_path):
    listing = warc.write_archives(pages(llm, [(1, "u", HTML)]), f"file://{tmp_path}/w").collect()
    with zipfile.ZipFile(listing[0].path.removeprefix("file://")) as z:
        assert z.testzip() is None and set(z.namelist()) == {warc.DATA, warc.INDEX, warc.PACKAGE}
