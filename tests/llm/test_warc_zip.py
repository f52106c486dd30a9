"""ZIP-packaged archives: round trips, and archives made by the standard library in other ways than the writer's."""

import base64
import gzip
import hashlib
import io
import json
import random
import zipfile

import pytest
from muster.llm import warc_zip
from muster.sources.tables import shared_folder

SCHEMA = "id long, uri string, payload string, path string, intact int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)


def back(spark, rows, **kw):
    made = warc_zip.written(warc_zip.with_revisits(pages(spark, rows), **kw), shared_folder(spark, "archives"))
    return made, sorted(map(tuple, warc_zip.read(made, payload=True).collect()), key=repr)


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(rows, least=0):
    out = []
    for i, uri, text in rows:
        text = text or ""
        same = [j for j, _, t in rows if (t or "") == text and j is not None]
        last = max(same, default=None)
        again = len(text.encode()) >= least and last is not None and i != last
        out.append((None if i is None else str(i), "revisit" if again else "response", uri, len(text.encode()), digest(text), str(last) if again else None, True, None if again else text.encode()))
    return sorted(out, key=repr)


def test_round_trip_of_defined_cases(spark):
    rows = [(1, "http://a/x", "<p>é\r\n\r\nWARC/1.1</p>"), (2, None, ""), (3, "http://a/y", None), (None, "http://b", "same"), (9, "http://b", "same"), (9, "http://b", "same"),
            (4, "http://b", "same"), (None, "u", "alone"), (None, "u", "alone"), (5, "http://c", "x\n" * 900_000), (6, "http://c", "\x00PK\x05\x06"), (-7, "http://c", "same")]
    made, got = back(spark, rows)
    assert got == expected(rows)
    assert sum(r.records for r in made.collect()) == len(rows)
    assert back(spark, rows, least=5)[1] == expected(rows, 5)


def test_empty_table(spark):
    made, got = back(spark, [])
    assert got == [] and made.count() == 0


def test_many_records_in_several_archives(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", rng.choice(["", "a", f"own {i}", "shared " * 50])) for i in range(3000)]
    monkeypatch.setattr(warc_zip, "ARCHIVE_RECORDS", 100)
    monkeypatch.setattr(warc_zip, "RANGE_BYTES", 2000)
    archive = warc_zip._Archive(shared_folder(spark, "own"), False)
    for i, uri, text in rows[:200]:
        archive.add(str(i), warc_zip.record(str(i), uri, text.encode(), None))
    assert archive.full()
    path, length, n = archive.close()
    ranges = list(warc_zip._located(warc_zip._File(path), length))
    assert n == 200 and len(ranges) > 5 and sum(r[3] for r in ranges) == archive.size
    _, got = back(spark, rows)
    assert got == expected(rows)


def zipped(folder, name, members, **how):
    """An archive by the standard library. members: (name, bytes, method)."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for member, data, method in members:
            info = zipfile.ZipInfo(member)
            info.compress_type, info.extra = method, how.get("extra", b"")
            with z.open(info, "w", force_zip64=how.get("zip64", False)) as f:
                f.write(data)
        z.comment = how.get("comment", b"")
    path = f"{folder}/{name}.zip"
    with open(path, "wb") as f:
        f.write(how.get("before", b"") + held.getvalue())
    return path, len(how.get("before", b"")) + len(held.getvalue())


@pytest.mark.parametrize("how", [{}, {"zip64": True}, {"before": b"junk" * 99}, {"comment": b"PK\x05\x06 not the end" * 9}, {"extra": b"\x99\x99\x04\x00abcd"}], ids=str)
@pytest.mark.parametrize("kind", ["indexed", "deflated index", "plain", "gzip", "one gzip member"])
def test_other_archives(spark, tmp_path, how, kind):
    texts = ["", "a", "é" * 5000, "b" * 100_000]
    raw = [warc_zip.record(str(i), f"http://h/{i}", t.encode(), "0" if i == 1 else None) for i, t in enumerate(texts)]
    stored = [gzip.compress(x) for x in raw] if kind in ("indexed", "deflated index", "gzip") else raw
    data = gzip.compress(b"".join(raw)) if kind == "one gzip member" else b"".join(stored)
    name = "archive/x.warc" + ".gz" * (kind != "plain")
    members = [("datapackage.json", b"{}", zipfile.ZIP_DEFLATED), (name, data, zipfile.ZIP_STORED), ("archive/y.warc.gz", b"not stored", zipfile.ZIP_DEFLATED)]
    if "index" in kind:
        at = [sum(map(len, stored[:i])) for i in range(len(stored))]
        lines = [f"k{i} 2024 {json.dumps({'filename': name[8:], 'offset': a, 'length': len(s)})}\n" for i, (a, s) in enumerate(zip(at, stored))]
        random.Random(2).shuffle(lines)
        members.append(("indexes/index.cdxj", "".join(lines).encode(), zipfile.ZIP_DEFLATED if kind == "deflated index" else zipfile.ZIP_STORED))
    archives = spark.createDataFrame([zipped(str(tmp_path), "one", members, **how)], "path string, length long")
    got = sorted((r.id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, r.intact) for r in warc_zip.read(archives).collect())
    assert got == [(str(i), "revisit" if i == 1 else "response", len(t.encode()), digest(t), "0" if i == 1 else None, True) for i, t in enumerate(texts)]


def test_more_entries_than_the_plain_end_record_counts(spark, tmp_path):
    members = [(f"notes/{i}", b"", zipfile.ZIP_STORED) for i in range(66_000)] + [("archive/x.warc", warc_zip.record("5", None, b"here", None), zipfile.ZIP_STORED)]
    path, length = zipped(str(tmp_path), "many", members)
    assert len(list(warc_zip.members(warc_zip._File(path), length))) == 66_001
    archives = spark.createDataFrame([(path, length)], "path string, length long")
    assert [(r.id, r.payload_bytes) for r in warc_zip.read(archives).collect()] == [("5", 4)]


def test_damaged_archives_are_errors(tmp_path):
    path, length = zipped(str(tmp_path), "cut", [("archive/x.warc", warc_zip.record("5", None, b"here", None), zipfile.ZIP_STORED)])
    with pytest.raises(ValueError, match="no end"):
        list(warc_zip.members(warc_zip._File(path), length - 30))
    changed = warc_zip._row(*next(warc_zip.records_of(iter([warc_zip.record("5", None, b"here", None).replace(b"here", b"gone")]))))
    assert changed[6] is False
