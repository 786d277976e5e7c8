import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratalode.llm.warc import ranges, read_records, reading_tasks, write_archives

BIG, SMALL = "é" * 600, "x" * 999
PAGES = [
    (1, "http://a/1", BIG), (5, "http://a/5", BIG), (3, None, BIG), (2, "http://a/2", SMALL), (4, "http://a/4", SMALL),
    (6, "http://a/6\r\nX: y", None), (7, "http://a/7", ""), (8, "u", "line\r\n\r\nWARC/1.1\r\n\r\n" * 200), (9, "u", "long " * 500_000),
    (None, "u", BIG), (5, "http://a/5", BIG),
]


def expected():
    newest = 5
    out = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        revisit = html == BIG and page_id != newest
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", newest if revisit else None))
    return sorted(out, key=repr)


def test_tasks_grow_with_the_bytes_of_the_archives(spark, tmp_path):
    def index(rows, length):
        return spark.range(rows).selectExpr("'f' AS file", f"id * {length} AS offset", f"CAST({length} AS BIGINT) AS length")

    assert reading_tasks(index(0, 1), 1 << 27) == 1
    assert reading_tasks(index(1000, 100), 1 << 27) == 1
    assert reading_tasks(index(1000, 1 << 20), 1 << 27) == 8  # twice the cores of the session
    assert reading_tasks(index(1000, 1 << 24), 1 << 27) == 125
    pages = spark.createDataFrame([(i, "u", f"{i} " * 3000) for i in range(300)], "page_id bigint, url string, html string")
    archives = write_archives(pages, f"file:{tmp_path}/many")
    found = read_records(archives, f"file:{tmp_path}/many", bytes_per_task=5000)
    tasks = found.withColumn("task", F.spark_partition_id()).select("task").distinct().count()
    assert tasks >= 5 and found.count() == 300


@pytest.mark.parametrize("most", [1, 8 << 20])
def test_round_trip(spark, tmp_path, rows, most):
    pages = spark.createDataFrame([(*p, "mine", 1) for p in PAGES], "page_id bigint, url string, html string, digest string, offset int")
    folder = f"file:{tmp_path}/warc"
    index = write_archives(pages.repartition(3), folder, max_file_bytes=2000)
    found = read_records(index, folder, gap=most, most=most)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(found.select(*columns)) == expected()
    assert rows(index.select(*columns)) == expected()
    payloads = {(r["page_id"], bytes(r["payload"])) for r in found.where("payload is not null").collect()}
    assert payloads == {(p, (h or "").encode()) for p, _, h in PAGES if h != BIG or p == 5}
    urls = {r["page_id"]: r["url"] for r in found.collect()}
    assert urls[3] is None and urls[6] == "http://a/6%0D%0AX: y"
    files = list(Path(tmp_path, "warc").glob("*.warc.gz"))
    assert len(files) >= 3
    assert all(gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: ") for f in files)


def test_selected_records_only(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    index = write_archives(pages, str(tmp_path / "warc"))
    found = read_records(index.where("page_id in (2, 9)"), str(tmp_path / "warc")).collect()
    assert sorted(r["page_id"] for r in found) == [2, 9]


def test_damage_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string")
    index = write_archives(pages, str(tmp_path / "warc"))
    file = next((tmp_path / "warc").glob("*.warc.gz"))
    data = gzip.decompress(file.read_bytes()).replace(b"text\r\n", b"tent\r\n")
    file.write_bytes(gzip.compress(data))
    bad = index.withColumn("length", index["length"] * 0 + file.stat().st_size)
    with pytest.raises(Exception, match="does not hold the payload"):
        read_records(bad, str(tmp_path / "warc")).collect()


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    index = write_archives(pages, str(tmp_path / "warc"))
    assert index.count() == 0
    assert read_records(index, str(tmp_path / "warc")).count() == 0


def test_ranges_join_neighbours():
    at = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("b", 0, 3), ("b", 3, 100)]
    rows = [{"file": f, "offset": o, "length": n} for f, o, n in at]
    sizes = lambda gap, most: [len(g) for g in ranges(rows, gap, most)]
    assert sizes(0, 1000) == [2, 1, 2]
    assert sizes(25, 1000) == [3, 2]
    assert sizes(25, 20) == [2, 1, 1, 1]
