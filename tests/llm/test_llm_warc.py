import hashlib
import io
import struct
import zipfile

import pyarrow.fs
import pytest

from affinity.llm import warc_zip
from affinity.llm.shared import open_store

PAGES = "page_id bigint, url string, html string, payload string, path int"


def archive(records, big=False, comment=b""):
    out = io.BytesIO()
    w = warc_zip.ArchiveWriter(out)
    for key, r in records:
        w.add(key, r)
    w.close()
    data = out.getvalue()
    if comment:
        data = data[:-2] + struct.pack("<H", len(comment)) + comment
    if big:  # the end record points to its ZIP64 form
        at = len(data) - 22 - len(comment)
        n, size, offset = struct.unpack_from("<HII", data, at + 10)
        end64 = warc_zip.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, offset)
        locator = warc_zip.LOCATOR + struct.pack("<IQI", 0, at, 1)
        end = warc_zip.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, len(comment))
        data = data[:at] + end64 + locator + end + comment
    return data


def record(key, payload, url="http://x.example/é", revisit=False, to=None):
    return warc_zip.build_record(key, url, payload, hashlib.sha1(payload).hexdigest(), to, revisit)


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("comment", [b"", b"a comment with PK\x05\x06 in it " * 3])
def test_ranges_of_records(big, comment):
    payloads = [b"", b"\r\n\r\n", b"x" * 70_000, "é漢".encode(), b"WARC/1.1\r\n\r\n"]
    data = archive([(str(i), record(str(i), p)) for i, p in enumerate(payloads)], big, comment)
    f = io.BytesIO(data)
    import zlib

    got = [warc_zip.parse_record(zlib.decompress(warc_zip._range(f, o, n), 31)) for o, n in warc_zip.record_ranges(f, len(data))]
    assert [r["payload"] for r in got] == payloads
    assert [r["record_id"] for r in got] == [str(i) for i in range(5)]
    if not big and not comment:  # and the standard library agrees on where the members are
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            assert [i.compress_type for i in z.infolist()] == [0, 0]
            assert z.testzip() is None


def test_zip64_central_entries():
    """Sizes and offsets that only the ZIP64 extra field holds."""
    data = archive([("1", record("1", b"hello"))])
    directory, length, count = warc_zip.central_directory(io.BytesIO(data), len(data))
    name = warc_zip.DATA.encode()
    at = data.index(warc_zip.CENTRAL, directory)
    packed, full = struct.unpack_from("<II", data, at + 20)
    old_extra = struct.unpack_from("<H", data, at + 30)[0]
    head = bytearray(data[at : at + 46 + len(name)])
    struct.pack_into("<II", head, 20, 0xFFFFFFFF, 0xFFFFFFFF)
    struct.pack_into("<H", head, 30, 28)
    struct.pack_into("<I", head, 42, 0xFFFFFFFF)
    extra = struct.pack("<HHQQQ", 1, 24, full or packed, packed, 0)
    rest = data[at + 46 + len(name) + old_extra : directory + length]
    table = bytes(head) + extra + rest
    end = warc_zip.END + struct.pack("<HHHHIIH", 0, 0, count, count, len(table), directory, 0)
    new = data[:directory] + table + end
    got = list(warc_zip.members(io.BytesIO(new), len(new)))
    assert [m[0] for m in got] == [warc_zip.DATA, warc_zip.INDEX]
    assert warc_zip.record_ranges(io.BytesIO(new), len(new)) == warc_zip.record_ranges(io.BytesIO(data), len(data))


def test_broken_archives():
    data = archive([("1", record("1", b"hello"))])
    for bad in (b"", b"not a zip", data[:-5], b"x" + data):
        with pytest.raises(ValueError):
            warc_zip.record_ranges(io.BytesIO(bad), len(bad))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(warc_zip.DATA, b"0" * 999)
        z.writestr(warc_zip.INDEX, b"")
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.record_ranges(out, len(out.getvalue()))
    with pytest.raises(ValueError, match="digest"):
        warc_zip.parse_record(record("1", b"hello").replace(b"hello", b"hallo"))


def expect(rows, least=1000):
    top = {}
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        if len(b) >= least and i is not None:
            top[b] = max(top.get(b, i), i)
    out = []
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        t = top.get(b, i)
        revisit = len(b) >= least and t != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", t if revisit else None))
    return sorted(out, key=str)


def rows_of(spark, pages, **options):
    manifest = warc_zip.write_archives(pages, **options)
    found = warc_zip.read_archives(spark, manifest).collect()
    for r in found:
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
        else:
            assert r["payload"] is None
    number = lambda x: None if x is None else int(x)
    got = [(number(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"])) for r in found]
    return sorted(got, key=str), manifest, found


def test_round_trip_and_edge_cases(spark):
    big, other = "<p>é</p>" * 200, "y" * 1000
    rows = [
        (1, "http://a", big, "p", 1), (5, None, big, None, None), (3, "u\r\nX: y\x00", big, "", 2), (4, "", None, "q", 1),
        (6, "u", "", "", 1), (7, "u", "z" * 999, "", 1), (8, "u", "z" * 999, "", 1), (9, "u", other, "", 1),
        (2, "u", other, "", 1), (9, "u", other, "", 1), (None, "u", other, "", 1), (None, "u", "q" * 2000, "", 1),
    ]
    pages = spark.createDataFrame(rows, PAGES)
    got, _, found = rows_of(spark, pages.repartition(3))
    assert got == expect(rows)
    assert {r["url"] for r in found if r["record_id"] == "3"} == {"u%0D%0AX: y%00"}
    assert rows_of(spark, pages.limit(0))[0] == []


def test_archives_are_cut_and_hot_payload(spark):
    hot = "h" * 5000
    rows = [(i, f"http://x/{i}", hot if i % 3 else f"<p>{i}</p>" * 300, "", i) for i in range(300)]
    got, manifest, _ = rows_of(spark, spark.createDataFrame(rows, PAGES).repartition(2), archive_bytes=4000)
    assert got == expect(rows)
    files = manifest.collect()
    assert len(files) > 5 and sum(r["records"] for r in files) == 300
    store, path = open_store(files[0]["path"])
    assert store.get_file_info(path).type == pyarrow.fs.FileType.File
