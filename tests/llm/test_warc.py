import base64
import gzip
import hashlib
import io
import json

import pytest

from tributary.llm import warc
from tributary.llm.common import table
from tributary.llm.warc import ArchiveSettings


def expected(pages):
    out = []
    for page_id, _, html in pages:
        same = [p for p, _, other in pages if (other or "") == (html or "") and p is not None]
        data = (html or "").encode()
        revisit = bool(same) and page_id != max(same)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=repr)


def through(spark, pages, **settings):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    settings = ArchiveSettings(**settings)
    members = warc.normalise_archives(warc.write_archives(df, settings), settings)
    return members, sorted((tuple(r)[:5] for r in warc.read_pages(members).collect()), key=repr)


ODD = [
    (1, "http://a/\r\nX-Evil: 1 é", "same"),
    (2, None, "same"),
    (2, None, "same"),
    (None, "http://b", "same"),
    (None, None, "own, without an id"),
    (3, "u", None),
    (4, "u", ""),
    (5, "u", "WARC/1.1\r\n\r\n\r\n\r\nnot a record"),
    (6, "u", "é\U0001f600" * 3),
    (7, "u", "x" * 3_000_000),
]


def test_rows_that_are_odd(spark):
    assert through(spark, ODD)[1] == expected(ODD)
    members, rows = through(spark, [(i, f"http://h/{i}", f"page {i % 7} " * 50) for i in range(200)], archive_bytes=5000)
    assert rows == expected([(i, "", f"page {i % 7} " * 50) for i in range(200)])
    assert members.count() > 3, "archives are closed at their size"


def test_pages_of_a_whole_table(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert through(spark, rows)[1] == expected(rows)


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, path string")
    assert warc.read_pages(warc.normalise_archives(warc.write_archives(empty))).count() == 0
    one = spark.createDataFrame([(1, "u", "x", "p", 3)], "page_id long, url string, html string, path string, records long")
    assert warc.read_pages(warc.normalise_archives(warc.write_archives(one))).count() == 1


def records(n):
    return [warc.record(i, f"http://h/{i}", b"x" * (i * 400_000), None, False, "2000-01-01T00:00:00Z") for i in range(n)]


@pytest.mark.parametrize("members", [1, 2, 4])
def test_each_record_becomes_a_member_that_stands_alone(members):
    each = records(4)
    step = -(-len(each) // members)
    source = b"".join(gzip.compress(b"".join(each[i : i + step])) for i in range(0, len(each), step))
    target = io.BytesIO()
    entries = list(warc.normalise(io.BytesIO(source), target, 6))
    data = target.getvalue()
    assert gzip.decompress(data) == b"".join(each)
    assert [gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]) for e in entries] == each
    assert [e["uri"] for e in entries] == [f"http://h/{i}" for i in range(4)]


@pytest.mark.parametrize("cut", [10, 300, -30, -9])
def test_cut_files_fail(cut):
    with pytest.raises((ValueError, warc.zlib.error)):
        list(warc.normalise(io.BytesIO(gzip.compress(b"".join(records(2)))[:cut]), io.BytesIO(), 6))


def test_records_cut_before_their_end():
    with pytest.raises(ValueError, match="cut off"):
        list(warc.normalise(io.BytesIO(gzip.compress(records(2)[1][:-500])), io.BytesIO(), 6))
    assert list(warc.normalise(io.BytesIO(gzip.compress(b"")), io.BytesIO(), 6)) == []


def test_the_index_is_a_file_of_its_own(spark, tmp_path):
    members, _ = through(spark, ODD)
    row = members.first()
    path = row["index"].removeprefix("file://")
    entries = [json.loads(line) for line in open(path, encoding="utf-8")]
    assert len(entries) == row["records"] and entries[0]["offset"] == 0


def test_a_lost_record_is_noticed(spark):
    df = spark.createDataFrame(ODD, "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(df)
    with pytest.raises(Exception, match="records instead of"):
        warc.normalise_archives(archives.selectExpr("path", "records + 1 as records"))


def test_each_archive_has_a_task_of_its_own(spark):
    pages = spark.range(400).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(cast(id as string), 40) as html").repartition(3)
    archives = warc.write_archives(pages, warc.ArchiveSettings(archive_bytes=20_000))
    n = archives.count()
    assert n > 8 and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    for each in (archives, warc.normalise_archives(archives).drop("index")):
        assert warc._dealt(each).selectExpr("spark_partition_id() as task").distinct().count() == n
    assert warc.read_pages(warc.normalise_archives(archives)).count() == 400
