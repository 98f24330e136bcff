import base64
import hashlib
import json
import zipfile
import zlib

import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from tributary.llm import zip_archives
from tributary.llm.zip_archives import _gzip, _record, directory, read_packages, write_packages


def pages_table(spark):
    rows = [(i, f"http://h/{i}", words(i % 7, 20) + "é") for i in range(30)] + [(50, None, None), (51, "http://é/\r\nx", ""), (52, "u", "x" * 300_000)]
    rows += [rows[3], (None, "u", words(1, 20) + "é"), (3, "u", "other payload")]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, digest int, path int")


@pytest.mark.parametrize("least,package", [(0, 64 << 20), (100, 2000)])
def test_records_come_back(spark, tmp_path, least, package):
    rows, table = pages_table(spark)
    packages = write_packages(table, str(tmp_path / "packages"), least, package)
    assert packages.count() >= (1 if package > 10**6 else 3)
    got = read_packages(packages).collect()
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    expected = []
    for i, url, html in rows:
        data = (html or "").encode()
        again = i is not None and len(data) >= least and first[html or ""] < i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((i, "revisit" if again else "response", first[html or ""] if again else None, len(data), digest, None if again else data))
    found = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload)) for r in got]
    found = [(*f[:5], f[5] if f[1] == "revisit" else f[5] or b"") for f in found]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    bare = read_packages(packages, payloads=False).collect()
    assert len(bare) == len(rows) and all(r.payload is None for r in bare)


def test_other_writers_packages_are_read(spark, tmp_path):
    """Raw and zipped members, comments, a compressed index with sort keys, an archive without index."""
    path, names = tmp_path / "other.wacz", ["a.warc.gz", "b.warc"]
    records = [_record(i, f"http://h/{i}", words(i, 30).encode(), None) for i in range(6)]
    lines = []
    with zipfile.ZipFile(path, "w") as package:
        package.comment = b"PK\x05\x06 not the end" * 20
        at, data = 0, b""
        for i, r in enumerate(records[:3]):
            part = _gzip(r)
            lines.append(f"com,h)/{i} 2020 " + json.dumps({"filename": names[0], "offset": str(at), "length": str(len(part))}))
            at, data = at + len(part), data + part
        package.writestr("archive/" + names[0], data)
        package.writestr("archive/" + names[1], b"".join(records[3:]))
        package.writestr("indexes/index.cdxj", "\n".join(lines), zipfile.ZIP_DEFLATED)
    found = read_packages(spark.createDataFrame([(str(path),), (None,)], "path string")).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in found) == [(i, words(i, 30)) for i in range(6)]


def test_directories_with_64_bits(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    path = tmp_path / "large.zip"
    with zipfile.ZipFile(path, "w") as package:
        for i in range(5):
            with package.open(f"m{i}", "w", force_zip64=True) as member:
                member.write(b"data" * (i + 10))
    system = pyarrow.fs.LocalFileSystem()
    with system.open_input_file(str(path)) as file:
        members = directory(file)
        assert {n: file.read_at(size, at) for n, (_, at, size) in members.items()} == {f"m{i}": b"data" * (i + 10) for i in range(5)}


def test_damaged_packages_are_errors(spark, tmp_path):
    good = tmp_path / "good.wacz"
    with zipfile.ZipFile(good, "w") as package:
        package.writestr("archive/a.warc.gz", _gzip(_record(1, "u", b"payload", None)))
    data = good.read_bytes()
    wrong = _record(1, "u", b"payload", None).replace(b"\r\n\r\npayload", b"\r\n\r\npayl0ad")
    cases = {"no.zip": b"nothing", "cut.wacz": data[:-30], "empty.wacz": b""}
    for name, content in cases.items():
        (tmp_path / name).write_bytes(content)
    with zipfile.ZipFile(tmp_path / "wrong.wacz", "w") as package:
        package.writestr("archive/a.warc.gz", _gzip(wrong))
    with zipfile.ZipFile(tmp_path / "packed.wacz", "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("archive/a.warc", zlib.compress(b"x"))
    for name in [*cases, "wrong.wacz", "packed.wacz"]:
        with pytest.raises(Exception, match="(?s)not a ZIP|ends early|digest|compressed|damaged|missing"):
            read_packages(spark.createDataFrame([(str(tmp_path / name),)], "path string")).collect()


def test_many_tasks_read(spark, tmp_path, monkeypatch):
    """The number of tasks follows the bytes of the ranges, not those of the rows that name them."""
    pages, table = pages_table(spark)
    packages = write_packages(table.repartition(6), str(tmp_path / "packages"))
    monkeypatch.setattr(zip_archives, "PACKAGES_A_TASK", 1)
    monkeypatch.setattr(zip_archives, "RANGE_BYTES", 200)
    found = read_packages(packages, payloads=False)
    assert found.count() == table.count() and found.rdd.getNumPartitions() > 3
    readers = found.select(F.spark_partition_id()).distinct().count()
    assert readers > 1


def test_empty_tables(spark, tmp_path):
    _, table = pages_table(spark)
    assert write_packages(table.filter("false"), str(tmp_path / "none")).count() == 0
    assert read_packages(spark.createDataFrame([], "path string")).count() == 0
    out = zip_archives.archive_pages(spark, table.filter("page_id < 5"))
    assert out.columns[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] and out.count() == 7
