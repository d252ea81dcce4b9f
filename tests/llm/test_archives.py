"""Archives: a round trip, and what a damaged file still gives."""

import gzip
import random
from pathlib import Path

from kgspark.llm import warc


def records(n: int = 50):
    rng = random.Random(4)
    return [warc.record(i, f"http://x/{i} \n", rng.randbytes(rng.randint(0, 3000)), None if i % 3 else 0) for i in range(n)]


def test_separator_is_an_empty_member():
    assert gzip.decompress(warc.EMPTY_MEMBER) == b""


def test_salvage():
    for pack in (lambda r: warc.member(r) + warc.EMPTY_MEMBER, lambda r: r):
        parts = [pack(r) for r in records()]
        data = b"".join(parts)
        good = list(warc.salvage(data))
        assert len(good) == 50 and all(x[2] is None for x in good)
        at = len(b"".join(parts[:7]))
        end = at + len(parts[7])
        hurt = bytearray(data)
        for k in range(at + len(parts[7]) // 2, at + len(parts[7]) // 2 + 9):
            hurt[k] ^= 0x5A
        for damaged, lost in ((bytes(hurt), {7}), (data[: end - 25] + data[end:], {7}), (data[:-25], {49}), (b"junk" + data, set()), (data + b"xx", set())):
            found = list(warc.salvage(damaged))
            assert {x[3]["warc-record-id"] for x in found if x[2] is None} == {f"<urn:page:{i}>" for i in range(50) if i not in lost}
            gaps = [x for x in found if x[2]]
            assert gaps and all(length > 0 for _, length, *_ in gaps)
    assert list(warc.salvage(b"")) == []


def test_salvage_inside_members():
    name = lambda found: [x[3]["warc-record-id"] for x in found if x[2] is None]
    want = lambda ids: [f"<urn:page:{i}>" for i in ids]
    parts = records()
    bad = [p if i != 7 else p[:-40] + b"?" + p[-39:] for i, p in enumerate(parts)]  # a digest or header that differs
    for level in (0, 5):
        whole = warc.member(b"".join(parts), level)
        assert name(warc.salvage(whole)) == want(range(50))
        # One bad record in a sound member, alone and between others.
        for data in (warc.member(b"".join(bad), level), b"".join(warc.member(b"".join(bad[k : k + 5]), level) for k in range(0, 50, 5))):
            found = list(warc.salvage(data))
            assert name(found) == want(i for i in range(50) if i != 7) and [x[2] for x in found if x[2]] and all(x[1] > 0 for x in found)
        # A cut tail, and another member behind it.
        for tail, more in ((b"", []), (warc.member(parts[49], level), [49])):
            cut = warc.member(b"".join(parts[:40]), level)[:-4000]
            found = list(warc.salvage(cut + tail))
            got = name(found)
            assert got == want([*range(len(got) - len(more)), *more]) and 30 < len(got) <= 40 and any(x[2] for x in found)
            if level:  # uncompressed, the member behind it is read as the cut one's content
                (gap,) = (x for x in found if x[2])
                assert gap[2] == "damaged member" and gap[0] + gap[1] == len(cut) and found[0][1] == gap[0]
        # A wrong check sum at the member's end: the record before it counts as hurt, unless it stands in the file uncompressed.
        found = list(warc.salvage(whole[:-8] + bytes(8) + parts[0]))
        assert name(found) == want([*range(49 if level else 50), 0]) and any(x[2] for x in found)
        hurt = bytearray(whole)
        hurt[len(whole) // 2] ^= 0x5A
        got = name(warc.salvage(bytes(hurt)))
        assert len(got) == len(set(got)) >= 20 and got[:20] == want(range(20))


def test_round_trip(spark, tmp_path):
    same = "<p>same</p>"
    rows = [(1, "http://a", same), (2, None, same), (3, "http://b\r\n", None), (4, "http://c", ""), (5, "http://d", "é\r\n\r\nWARC/1.1 😀"), (5, "http://d", "é\r\n\r\nWARC/1.1 😀"), (None, "http://e", same), (6, "http://f", "x" * 300_000), (0, "http://g", same)]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, first string, digest string").repartition(3)
    folder = str(tmp_path / "archives")
    warc.write_archives(pages, folder, records_per_file=2)
    found = warc.read_archives(spark, folder).withColumn("page_id", warc.page_id("record_id")).collect()
    assert len(found) == len(rows) and all(r.reason is None for r in found)
    text = {i: (t or "").encode() for i, _, t in rows}
    for r in found:
        assert r.payload_bytes == len(text[r.page_id]) and r.payload_digest == warc.base32_sha1(text[r.page_id])
        assert (r.record_type == "revisit") == (r.refers_to is not None) == (r.page_id in (1, 2, None, 4))
        assert r.payload is None if r.refers_to else bytes(r.payload) == text[r.page_id]
    assert {r.refers_to for r in found if r.page_id in (1, 2, None)} == {"<urn:page:0>"}
    for name in Path(folder).glob("part-*"):
        assert gzip.decompress(name.read_bytes()).count(b"WARC/1.1\r\nWARC-Type") <= 2
    warc.write_archives(pages.filter("page_id < 0"), folder + "-none")
    assert warc.read_archives(spark, folder + "-none").count() == 0
    big = str(tmp_path / "least")
    warc.write_archives(pages, big, at_least=100)
    assert {r.record_type for r in warc.read_archives(spark, big, with_payload=False).collect()} == {"response"}


def test_digests_in_sql_and_python(spark):
    import hashlib

    from pyspark.sql import functions as F

    df = spark.createDataFrame([("",), ("abc",)], "t string").select("t", warc.base32_of_hex(F.sha1("t")).alias("d"))
    assert all(r.d == warc.base32_sha1(r.t.encode()) and len(hashlib.sha1(r.t.encode()).digest()) == 20 for r in df.collect())
