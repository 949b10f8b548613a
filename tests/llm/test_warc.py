"""Archives written and read back, whole and damaged."""

import base64
import gzip
import hashlib
import random
from pathlib import Path

import pytest

from compare import difference, open_tables
from loomtally.llm import warc
from loomtally.llm.queries import QUERIES, SQL

COLUMNS = "page_id long, url string, html string, key string, copy int, id int, first int, n int, no_id int, path string"


def expected(pages):
    first = {}
    for page_id, _, html in pages:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in pages:
        data, known = (html or "").encode(), first.get(html or "")
        again = known is not None and (page_id is None or page_id > known)
        name = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), name, "revisit" if again else "response", known if again else None))
    return sorted(out, key=str)


def site(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    pages = [(i, f"http://h/{i}", "".join(rng.choices("aé<>\r\n \x00😀", k=rng.randrange(200)))) for i in range(60)]
    pages += [(100 + i, "u", pages[i % 7][2]) for i in range(30)]
    pages += [(None, "u", pages[0][2]), (None, "u", "nobody else"), (None, "u", "nobody else"), (7, pages[7][1], pages[7][2])]
    pages += [(200, None, None), (201, "a\r\nWARC-Type: x é", ""), (202, "u", "WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n")]
    return pages + [(203, "u", "\r\n\r\n" * 5), (204, "u", "long " * 60_000), (-5, "u", "long " * 60_000)]


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("size", [300, 8_000_000])
def test_round_trip(spark, rows, tmp_path, compressed, size):
    pages = site(size)
    folder = str(tmp_path / "w")
    docs = rows([(*p, "k", 1, 1, 1, 1, 1, "p") for p in pages], COLUMNS)
    warc.write_archives(docs, folder, compressed, size)
    found = warc.salvage(spark, folder).collect()
    assert [r for r in found if r.problem] == []
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=str) == expected(pages)
    texts = {(p[0], (p[2] or "").encode()) for p in pages}
    assert all((r.page_id, bytes(r.payload)) in texts for r in found if r.record_type == "response")
    files = [p.read_bytes() for p in (tmp_path / "w").glob("part-*")]
    whole = [gzip.decompress(f) if compressed and f else f for f in files]
    assert sum(w.count(b"WARC/1.1\r\nWARC-Type") for w in whole) == len(pages)
    assert all(w.endswith(b"\r\n\r\n") for w in whole if w)


def test_urls_cannot_break_headers():
    data = warc.record(1, "http://x/\r\nWARC-Type: metadata\r\n\r\né", b"p", None)
    end, found = warc.read_record(data, 0)
    assert end == len(data) and found["record_type"] == "response" and found["payload"] == b"p"
    assert found["url"] == "http://x/%0D%0AWARC-Type:%20metadata%0D%0A%0D%0A%C3%A9"


def test_a_member_of_16_megabytes(spark, rows, tmp_path):
    folder = str(tmp_path / "w")
    warc.write_archives(rows([(1, "u", "z" * 17_000_000), (2, "u", "y")], "page_id long, url string, html string", 1), folder)
    found = warc.salvage(spark, folder, payloads=False).collect()
    assert sorted((r.page_id, r.payload_bytes, r.problem, r.payload) for r in found) == [(1, 17_000_000, None, None), (2, 1, None, None)]


def archive(seed: int, compressed: bool) -> tuple[list[bytes], list[int]]:
    rng = random.Random(seed)
    parts = [warc.record(i, f"u{i}", bytes(rng.choices(b"abc\r\n<", k=rng.randrange(1, 900))), None) for i in range(25)]
    parts = [warc.member(p) for p in parts] if compressed else parts
    return parts, [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("harm", ["flip", "cut", "insert", "remove", "zeros"])
def test_later_records_are_recovered(compressed, harm):
    for seed in range(25):
        parts, ends = archive(seed, compressed)
        rng = random.Random(seed)
        hit = rng.randrange(len(parts))
        at = ends[hit] + rng.randrange(len(parts[hit]))
        data = bytearray(b"".join(parts))
        if harm == "flip":
            data[at] ^= 1 << rng.randrange(8)
        elif harm == "cut":
            del data[at:]
        elif harm == "insert":
            data[at:at] = bytes(rng.choices(b"junk\x1f\x8b\x08WARC/1.0\r\n", k=rng.randrange(1, 50)))
        elif harm == "remove":
            del data[at : at + rng.randrange(1, 40)]
        else:
            data[at : at + 30] = bytes(len(data[at : at + 30]))
        found = list(warc.salvaged(bytes(data)))
        good = {f["page_id"]: f for f in found if not f.get("problem")}
        gaps = [f for f in found if f.get("problem")]
        # Everything but the harmed record, and the next where bytes of both went, is there and right.
        # (Nothing guards the header lines of a plain record but their form.)
        whole = {f["page_id"]: f for f in warc.salvaged(b"".join(parts))}
        for i in range(len(parts)) if harm != "cut" else range(hit):
            assert i in (hit, hit + 1) or good[i]["payload"] == whole[i]["payload"]
        # Records and gaps cover the archive without overlap.
        places = sorted({(f["start"], f["end"]) for f in found})
        assert all(a[1] == b[0] for a, b in zip(places, places[1:]))
        assert not places or (places[0][0] == 0 and places[-1][1] == len(data))
        assert len(gaps) <= 2 and all(g["end"] > g["start"] for g in gaps)


def test_known_end_of_damage_limits_the_gap():
    inner = warc.record(99, "u", b"quoted", None)
    outer = warc.record(1, "u", b"a page that quotes " + inner + b" and goes on", None)
    after = warc.record(2, "u", b"next", None)
    harmed = outer.replace(b"goes on", b"went on")
    found = list(warc.salvaged(harmed + after))
    assert [(f.get("problem"), f.get("page_id")) for f in found] == [("block digest differs", None), (None, 2)]
    assert (found[0]["start"], found[0]["end"]) == (0, len(harmed))


def test_mixed_archive_and_foreign_records(spark, tmp_path):
    two = warc.record(1, "a", b"one", None) + warc.record(2, "b", b"two", None)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:x>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    folded = b"WARC/1.0\r\nWARC-Type:\r\n resource\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    Path(tmp_path / "x.warc").write_bytes(warc.member(two) + b"garbage" + info + warc.member(b"") + folded)
    Path(tmp_path / "empty.warc").write_bytes(b"")
    found = sorted(warc.salvage(spark, str(tmp_path)).collect(), key=lambda r: (r.start, r.page_id or 0))
    assert [(r.record_type, r.page_id, r.payload_bytes) for r in found] == [
        ("response", 1, 3), ("response", 2, 3), (None, None, None), ("warcinfo", None, 2), ("resource", None, 0),
    ]
    assert found[2].end - found[2].start == 7 and found[2].problem == "no version line"


def test_empty_table(rows):
    assert warc.round_trip(rows([], COLUMNS)).collect() == []


def test_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    tables = open_tables(folder)
    assert difference(QUERIES["op13_warc"](spark, folder), tables, SQL["op13_warc"]) is None
    tables.close()
