"""Archives written and read back, whole and damaged."""

import gzip
import hashlib
import random
import re
import zlib

import pytest

from ledgerspark.llm import warc

BIG = "<p>" + "привет мир " * 200
SCHEMA = "page_id long, url string, html string"
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://a/ 9\r\nX: y", BIG), (3, None, None), (4, "http://a/4", ""), (5, "http://a/5", "short"), (6, "u", "short"),
    (None, "u", BIG + "n"), (None, "u", BIG + "n"), (7, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40), (8, "u", "\r\n\r\n\x00" * 600), (9, "http://a/9b", BIG),
]


def expected(pages):
    out = []
    for page, _, html in pages:
        data = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == data and p is not None] if len(data) >= 1000 else []
        head = max(same, default=None)
        revisit = head is not None and page != head
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


def archives(spark, rows, folder, **options):
    warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), str(folder), **options)
    return sorted(folder.glob("part-*"))


def test_round_trip(spark, tmp_path):
    files = archives(spark, PAGES, tmp_path / "w")
    found = warc.salvage(spark, str(tmp_path / "w"))
    assert sorted([tuple(r) for r in warc.digests(found).collect()], key=str) == expected(PAGES)
    assert warc.gaps(found).count() == 0
    full = {(r["record_id"]): bytes(r["payload"] or b"") for r in warc.revisited(found).collect()}
    assert full[next(k for k in full if k.startswith("<urn:page:1:"))] == BIG.encode()
    # any gzip reader reads the files, and every record is a member of its own
    text = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert text.count(b"WARC-Record-ID: <urn:page:") == len(PAGES)
    uris = {r["uri"] for r in warc.records(found).collect()}
    assert "http://a/%209%0D%0AX:%20y" in uris and None in uris


def test_small_archives_and_clashing_columns(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x", b"y", 1, "z") for p in PAGES], SCHEMA + ", payload string, same binary, head int, piece string")
    warc.write(pages, str(tmp_path / "w"), archive_bytes=1)
    assert len(list((tmp_path / "w").glob("part-*"))) == len(PAGES)
    assert sorted([tuple(r) for r in warc.digests(warc.salvage(spark, str(tmp_path / "w"))).collect()], key=str) == expected(PAGES)


def test_no_pages(spark, tmp_path):
    archives(spark, [], tmp_path / "w")
    assert warc.salvage(spark, str(tmp_path / "w")).count() == 0


def series(rng, gzipped):
    """Records (id, bytes of the member or record) in a row."""
    made = []
    for i in range(12):
        data = warc.written(i, "u", rng.randbytes(rng.choice([0, 10, 5000])), None, "2024-01-01T00:00:00Z")
        made.append(warc.member(data) if gzipped else data)
    return made


@pytest.mark.parametrize("gzipped", [True, False])
def test_everything_but_damaged_records_is_recovered(gzipped):
    rng = random.Random(7)
    for _ in range(60):
        made = series(rng, gzipped)
        hurt = sorted(rng.sample(range(12), rng.randint(0, 3)))
        pieces = list(made)
        for i in hurt:
            kind = rng.randrange(4)
            piece = bytearray(made[i])
            if kind == 0:  # cut off
                piece = piece[: rng.randrange(1, len(piece) - 4)]
            elif kind == 1:  # a byte of the block changed
                at = rng.randrange(len(piece) - 30, len(piece) - 8) if gzipped else piece.index(b"HTTP") + 2
                piece[at] ^= 0x55
            elif kind == 2:  # no beginning
                del piece[:3]
            else:  # rubbish before it: the record itself is sound
                piece = bytearray(rng.choice([b"\0" * 9, b"\x1f\x8b\x08rubbish", b"WARC/1.1\r\nrubbish\r\n"])) + piece
            pieces[i] = bytes(piece)
        data = b"".join(pieces)
        found, covered = [], 0
        for offset, length, reason, records in warc.walk(data):
            assert offset == covered and length > 0
            covered += length
            assert (reason is None) == bool(records)
            found += [int(f["warc-record-id"].split(":")[2]) for f, _ in records]
        assert covered == len(data)
        sound = [i for i in range(12) if i not in hurt]
        assert set(sound) <= set(found) <= set(range(12)) and found == sorted(found)


def test_gap_log_of_a_damaged_archive(spark, tmp_path):
    (path,) = archives(spark, [(i, "u", f"{i} " * 900) for i in range(6)], tmp_path / "w", archive_bytes=1 << 30)[:1] or [None]
    whole = [r for r in warc.records(warc.salvage(spark, str(tmp_path / "w"))).orderBy("path", "offset").collect() if r["path"].endswith(path.name)]
    data = bytearray(path.read_bytes())
    first = whole[0]
    data[first["offset"] + first["length"] // 2] ^= 0xFF
    hurt = tmp_path / "hurt"
    hurt.mkdir()
    (hurt / path.name).write_bytes(data)
    found = warc.salvage(spark, str(hurt))
    (gap,) = warc.gaps(found).collect()
    assert (gap["offset"], gap["length"]) == (first["offset"], first["length"]) and gap["reason"].startswith("member")
    assert [r["record_id"] for r in warc.records(found).orderBy("offset").collect()] == [r["record_id"] for r in whole[1:]]


def test_checks_of_a_record():
    good = warc.written(1, "u", b"abc", None, "2024-01-01T00:00:00Z")
    fields, block, end = warc.parse(good, 0)
    assert end == len(good) and block.endswith(b"\r\n\r\nabc") and warc.payload_of(fields, block) == (b"abc", 3)
    for bad, check in [
        (good.replace(b"WARC/1.1", b"WARC/x"), "version line"), (re.sub(rb"Content-Length: (?=\d\d)", b"Content-Length: -", good), "content length"), (good[:-1], "record end"),
        (good[:-5], "block length"), (good.replace(b"abc\r\n", b"abd\r\n"), "block digest"), (good[:40], "header"), (good.replace(b"WARC-Type:", b"\xff\xfe:"), "header"),
    ]:
        with pytest.raises(warc.Damaged, match=check):
            warc.parse(bad, 0)


def test_a_payload_that_does_not_fit_its_digest_is_quarantined(spark, tmp_path):
    record = warc.written(1, "u", b"abc", None, "2024-01-01T00:00:00Z")
    block = record[record.index(b"HTTP/1.1") : -4]
    wrong = record.replace(warc.sha1_label(hashlib.sha1(b"abc").digest()).encode(), warc.sha1_label(hashlib.sha1(b"abd").digest()).encode())
    assert warc.digest_holds(warc.sha1_label(hashlib.sha1(block).digest()), block)
    (tmp_path / "part-0").write_bytes(warc.member(wrong) + warc.member(record))
    found = warc.salvage(spark, str(tmp_path))
    assert [r["reason"] for r in warc.gaps(found).collect()] == ["payload digest"]
    assert warc.records(found).count() == 1


def test_foreign_members_of_several_records():
    parts = [warc.written(i, "u", b"x" * i, None, "2024-01-01T00:00:00Z") for i in range(3)]
    data = zlib.compress(b"".join(parts), wbits=31) + warc.EMPTY_MEMBER + b"".join(parts)
    assert [len(records) for _, _, _, records in warc.walk(data)] == [3, 0, 1, 1, 1]
