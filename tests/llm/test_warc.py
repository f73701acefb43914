"""Archives read back as written; the index is in order; revisits refer to the smallest id."""

import gzip
import hashlib
import random
from urllib.parse import urlsplit

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import warc

LONG = "<p>" + "long page " * 50_000
SAME = "<html>" + "the same page " * 20
ROWS = [
    (5, "http://www.Example.com/a?b#c", SAME),
    (3, "https://example.com/a?b", SAME),
    (3, "https://example.com/a?b", SAME),
    (9, None, SAME),
    (None, "http://x.org", SAME),
    (None, "http://x.org", SAME),
    (10, "http://y.org:80/\r\nWARC-Type: response\r\n", None),
    (11, "", ""),
    (12, "no url at all", "short"),
    (13, "no url at all", "short"),
    (14, "http://z.org/ä", LONG),
    (15, "http://z.org/ä", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9),
    (-4, "http://z.org/ä", "ünï " * 40),
    (20, "http://e.org/", "x" * 99),
    (21, "http://e.org/", "x" * 99),
]
COLUMNS = "page_id long, url string, html string, captured string, file string, offset string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], COLUMNS)


def expected(rows):
    firsts = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and i is not None:
            firsts[body] = min(i, firsts.get(body, i))
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        first = firsts.get(body)
        again = first is not None and first != i
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_awkward_pages(spark):
    found = warc.archived(pages(spark, ROWS).repartition(3))
    assert got(found) == expected(ROWS)
    assert all(r.intact for r in found.collect())


def test_empty(spark):
    assert warc.archived(pages(spark, [])).collect() == []


def test_many_copies_of_one_page_and_url(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["http://hot.org/"] * 3 + [f"http://h{i % 50}.org/x"]), SAME if i % 3 else f"{SAME}{i}") for i in range(900)]
    rnd.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = warc.archived(pages(spark, rows).repartition(7))
        assert got(found) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    met = found.orderBy("index_part", "index_row").collect()
    assert len({r.index_part for r in met}) > 1
    order = [(r.url_key, r.captured, r.page_id) for r in met]
    assert order == sorted(order)
    for url in {r.url_key for r in met}:
        assert [r.capture for r in met if r.url_key == url] == list(range(1, 1 + sum(r.url_key == url for r in met)))


def test_archives_are_plain_gzip_and_roll_over(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    p = warc.marked(pages(spark, ROWS), F.lit(1_700_000_000))
    listed = warc.written(p.repartition(2), folder, most_bytes=400).collect()
    assert sum(r.records for r in listed) == len(ROWS) and len(listed) > 4
    captures = warc.read(spark.read.parquet(f"{folder}/archives"), folder).collect()
    assert len(captures) == len(ROWS) and {r.captured for r in captures} == {1_700_000_000}
    for r in captures:
        data = (tmp_path / "w" / r.file).read_bytes()
        record = gzip.decompress(data[r.offset : r.offset + r.length])
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
        assert (b"\r\nWARC-Refers-To: " in record.split(b"\r\n\r\n")[0]) == (r.record_type == "revisit")
    # an archive that no list names (a lost attempt's) is not read
    (tmp_path / "w" / "000000-0000-lost.warc.gz").write_bytes(b"half a record")
    assert len(warc.read(spark.read.parquet(f"{folder}/archives"), folder).collect()) == len(ROWS)


def test_a_cut_or_changed_archive_is_an_error(tmp_path):
    record = warc.record(1, "http://a", b"x" * 300, 0, "0" * 64, "response", None)
    (tmp_path / "a").write_bytes(gzip.compress(record)[:-20])
    with (tmp_path / "a").open("rb") as stream, pytest.raises(ValueError, match="ends within"):
        list(warc.members(stream))
    with pytest.raises(ValueError, match="length"):
        warc.parsed(record[:-5])
    assert warc.capture(record)[-1] is False


def test_url_keys(spark):
    keys = {
        "http://www.Example.com/A?b#c": "com,example)/A?b",
        "https://example.com:443": "com,example)/",
        "HTTP://a.b.C:8080/x//": "c:8080,b,a)/x//",
        "//x": ")//x",
        "example.org?q": "org,example)?q",
        "": ")/",
    }
    df = spark.createDataFrame([(k,) for k in keys], "url string")
    assert {r.url: r.k for r in df.select("url", warc.url_key(F.col("url")).alias("k")).collect()} == keys
    assert urlsplit(warc.uri("http://a/b c\r\nd")).path == "/b%20c%0D%0Ad"


@given(st.lists(st.lists(st.integers(0, 50)), max_size=9))
def test_loser_tree(runs):
    runs = [sorted((x, i) for x in r) for i, r in enumerate(runs)]
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)
