import gzip
import hashlib
import random

from gleanrow.llm import warc

PAGES = "page_id long, url string, html string, digest string, payload string"


def some_pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash") for i, u, h in rows], PAGES)


def test_round_trip_with_revisits(spark):
    same = "<p>é WARC/1.1\r\n\r\n" * 20
    rows = [(5, "http://a", same), (3, None, same), (9, "http://b\r\nX: y", same), (1, "u", None), (2, "u", ""), (4, "u", "x" * 99),
        (6, "u", "x" * 99), (None, "u", same), (7, "u", "y" * 300_000)]
    got = {r["page_id"]: r for r in warc.round_trip(some_pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        data = (html or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("revisit", 3) if html == same and i != 3 else ("response", None))
    assert got[3]["url"] is None and got[9]["url"] == "http://b%0D%0AX: y"
    assert warc.round_trip(some_pages(spark, [])).count() == 0


def test_repeated_rows(spark):
    got = warc.round_trip(some_pages(spark, [(1, "u", "z" * 200)] * 3 + [(2, "u", "z" * 200)] * 2)).collect()
    assert sorted((r["page_id"], r["record_type"]) for r in got) == [(1, "response")] * 3 + [(2, "revisit")] * 2


def archive(n, pack):
    records = [warc.make_record(i, f"http://a/{i}", b"payload %d " % i * (i % 40), "0", None) for i in range(n)]
    return [pack(r) for r in records]


def test_files_are_gzip(spark, tmp_path):
    warc.write_archives(some_pages(spark, [(i, "u", f"page {i} " * 9) for i in range(30)]), str(tmp_path / "w"), records_per_file=7)
    files = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    assert len(files) > 3
    assert sum(gzip.decompress(f.read_bytes()).count(b"WARC/1.1\r\n") for f in files) == 30


def test_salvage(spark, tmp_path):
    rng = random.Random(6)
    for pack, between in ((warc.gzip_member, warc.SEPARATOR), (bytes, b"")):
        units = archive(40, pack)
        whole = between.join(units)
        assert [x[0] for x in warc.salvage(whole)] == ["record"] * 40
        for _ in range(25):
            k = rng.randrange(1, 39)
            start = whole.find(units[k])
            at = start + rng.randrange(len(units[k]))
            broken = whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1 :]
            found = list(warc.salvage(broken))
            assert len([x for x in found if x[0] == "record"]) >= 39
            for x in found:
                if x[0] == "gap":
                    assert start <= x[1] < x[2] <= start + len(units[k]) + len(between)
        cut = list(warc.salvage(whole[: len(whole) - 5]))
        # a member without its trailer still gives its record, which passes its own checks
        assert cut[-1][0] == "gap" and len([x for x in cut if x[0] == "record"]) == (40 if between else 39)
        (tmp_path / f"{len(between)}.warc").write_bytes(b"junk\r\n" + whole + b"tail")
    found = warc.read_archives(spark, str(tmp_path))
    assert warc.records(found).count() == 80
    assert sorted((r["start"], r["stop"] - r["start"]) for r in warc.gaps(found).collect() if r["start"] == 0) == [(0, 6), (0, 6)]
    assert warc.gaps(found).count() == 4


def test_salvage_inside_a_member():
    """An archive that is one member: records before a cut, and around a bad record, are kept."""
    records = [warc.make_record(i, f"http://a/{i}", (f"payload {i} ".encode() + bytes(random.Random(i).randbytes(300))) * 20, "0",
        None) for i in range(40)]
    kept = lambda data: [int(x[3]["fields"][b"warc-record-id"].split(b":")[-1][:-1]) for x in warc.salvage(data) if x[0] == "record"]
    whole = warc.gzip_member(b"".join(records))
    assert kept(whole) == list(range(40))
    cut = list(warc.salvage(whole[: len(whole) // 2]))
    assert 10 < len(kept(whole[: len(whole) // 2])) < 30 and kept(whole[: len(whole) // 2]) == list(range(len(cut) - 1))
    assert cut[-1][0] == "gap" and "records saved" in cut[-1][3]
    spoilt = records[:7] + [records[7].replace(b"payload 7", b"payload !", 1)] + records[8:]
    assert kept(warc.gzip_member(b"".join(spoilt))) == [i for i in range(40) if i != 7]
    bad = bytearray(whole)
    bad[len(bad) // 2] ^= 0xFF
    follow = warc.gzip_member(warc.make_record(99, None, b"next", "0", None))
    found = kept(bytes(bad) + follow)
    assert found[-1] == 99 and found[:10] == list(range(10))


def test_very_long_page(spark):
    html = "<p>é</p>" * 1_000_000
    rows = warc.round_trip(some_pages(spark, [(1, "u", html), (2, "u", html)])).orderBy("page_id").collect()
    assert [(r["record_type"], r["payload_bytes"], r["refers_to"]) for r in rows] == [("response", 9_000_000, None),
        ("revisit", 9_000_000, 1)]
    assert rows[0]["payload_digest"] == hashlib.sha256(html.encode()).hexdigest()


def test_records_of_members_with_a_wrong_sum():
    """A member whose checksum is wrong gives its record, however small; equal records of two such members are two."""
    rng = random.Random(7)
    for words in (5, 50, 500):
        units = []
        for i in range(100):
            text = " ".join(f"w{rng.randrange(900)}" for _ in range(words)).encode()
            unit = bytearray(warc.gzip_member(warc.make_record(i, "http://a", text, "0", None)))
            unit[-6] ^= 0xFF  # in the CRC
            units.append(bytes(unit))
        found = list(warc.salvage(warc.SEPARATOR.join(units)))
        assert sum(x[0] == "record" for x in found) == 100 and found[-1][0] == "gap"
        twice = list(warc.salvage(units[0] + units[0] + units[1]))
        assert sum(x[0] == "record" for x in twice) == 3
    stored = bytearray(warc.gzip_member(warc.make_record(1, None, b"plain text", "0", None), 0))
    stored[-6] ^= 0xFF  # nothing is compressed: the record's own version line is found again inside
    assert sum(x[0] == "record" for x in warc.salvage(bytes(stored) + warc.SEPARATOR)) == 1
