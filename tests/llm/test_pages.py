"""Nearest neighbours, sharding, URL filter and archives."""

import base64
import gzip
import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import ann, sharding, url_templates, warc
from starloom.llm.common import shared_path
from starloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def brute_nearest(rows, k):
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            found = sorted((-float(np.dot(np.float64(x), np.float64(y))), v) for v, y in rows if v != q and len(y) == len(x))
            out[q] = found[:k]
    return out


def test_probing_order_is_by_expected_distance():
    order = ann.probing_order(3, 27)
    assert order[0] == () and order[1] == (1,) and len(set(order)) == 27
    assert all(7 - j not in moves for moves in order for j in moves)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_recall(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_nearest(rows, 20)
    got = {}
    for r in sorted(QUERIES["op2_nearest"](spark, sf).collect()):
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(want)
    hits = sum(len({v for _, v in want[q]} & {r.vec_id for r in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    by_id = dict(rows)
    for q, found in got.items():
        assert [r.rank for r in found] == list(range(1, len(found) + 1))
        assert all(math.isclose(r.score, float(np.dot(np.float64(by_id[q]), np.float64(by_id[r.vec_id]))), rel_tol=1e-12, abs_tol=1e-12) for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)


def test_nearest_edges(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(100)]  # one vector shared by all
    rows += [(100, [2.0, 1.0], 0), (101, [0.0, 0.0], 0), (102, None, 0), (103, [], 0), (104, [1.0, None], 0), (105, [float("nan"), 1.0], 0), (106, [float("inf"), 1.0], 0), (None, [1.0, 0.0], 0), (120, [1.0, 2.0, 3.0], 0), (0, [1.0, 0.0], 0)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in sorted(ann.search(data, F.col("vec_id") % 20 == 0, k=5, block=16).collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got[0] == [(100, 2.0), (1, 1.0), (2, 1.0), (3, 1.0), (4, 1.0)]
    assert got[20] == [(100, 2.0), (0, 1.0), (1, 1.0), (2, 1.0), (3, 1.0)]
    assert got[100] == [(0, 2.0), (1, 2.0), (2, 2.0), (3, 2.0), (4, 2.0)]
    assert 120 not in got  # its only candidate of the same length is itself
    assert ann.search(data.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_blocks_do_not_change_the_result(spark):
    data = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    asks = F.col("vec_id") % 20 == 0
    whole, dealt = (sorted(map(tuple, ann.search(data, asks, block=b).collect())) for b in (100_000, 8))
    assert whole == dealt


def brute_table(names, size):
    import xxhash

    order = []
    for n in names:
        at, skip = xxhash.xxh64_intdigest(n.encode(), 7) % size, xxhash.xxh64_intdigest(n.encode(), 8) % (size - 1) + 1
        order.append([(at + i * skip) % size for i in range(size)])
    table = {}
    while len(table) < size:
        for i, slots in enumerate(order):
            if len(table) < size:
                table[next(s for s in slots if s not in table)] = i
    return [table[i] for i in range(size)]


def test_lookup_table():
    names = sharding.shard_names(7)
    table = sharding.fill_table(names, 211)
    assert table == brute_table(names, 211)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.fill_table(names[:-1], 211)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6)
    assert moved <= 0.25 * 211
    heavy = np.bincount(sharding.fill_table(names, 2003, [2, 1, 1, 1, 1, 1, 1]))
    assert 1.8 < heavy[0] / heavy[1] < 2.2
    for bad in (lambda: sharding.fill_table(names, 210), lambda: sharding.fill_table([], 211), lambda: sharding.fill_table(["a", "a"], 211)):
        with pytest.raises(ValueError):
            bad()


def test_placement(spark):
    rows = spark.createDataFrame([(i % 50, "x") for i in range(200)] + [(None, "x")], "doc_id long, text string")
    got = sharding.place(rows, "doc_id", sharding.shard_names(4), 211, keep=["text"])
    assert got.count() == 201 and got.groupBy("doc_id").agg(F.count_distinct("shard").alias("n")).where("n <> 1").count() == 0
    table = sharding.fill_table(sharding.shard_names(4), 211)
    assert all(table[r.slot] == r.shard for r in got.collect())
    path = shared_path(spark, "test-shards")
    sharding.write_shards(got, path, files_per_shard=3)
    assert spark.read.parquet(path).count() == 201
    assert sharding.place(rows.limit(0), "doc_id", ["a"]).count() == 0
    with pytest.raises(ValueError, match="shard"):
        sharding.place(rows.withColumn("shard", F.lit(1)), "doc_id", ["a"], keep=["shard"])
    assert QUERIES["op4_sharding"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


URLS = {
    1: ("http://A.Example.COM/en/1?x=/en/", "a.example.com", "/en/1", "example.com/en/", "block"),
    2: ("https://www.example.com/en/2#f", "www.example.com", "/en/2", "www.example.com/en/", "allow"),
    3: ("https://x.com", "x.com", "", None, "allow"),
    4: ("https://com/", "com", "/", "com/", "allow"),
    5: ("x://n.net/es/9", "n.net", "/es/9", "net/es/", "block"),
    6: ("x://n.net/es", "n.net", "/es", None, "allow"),
    7: ("x://notnet/es/", "notnet", "/es/", None, "allow"),
    8: (None, "", "", None, "allow"),
    9: ("no scheme", "", "", None, "allow"),
    10: ("", "", "", None, "allow"),
    11: ("http://?q", "", "", None, "allow"),
    12: ("x://h.org/a\nb/" + "y" * 5000, "h.org", "/a\nb/" + "y" * 5000, None, "allow"),
    13: ("x://É.net/fr/1://z.com/", "É.net", "/fr/1://z.com/", "net/fr/", "block"),
}


def test_rules(spark):
    rows = [(i, u[0], "z") for i, u in URLS.items()] + [(1, URLS[1][0], "z"), (None, None, "z")]
    got = url_templates.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == URLS[r.page_id or 8][1:], r.page_id
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_templates.judge(empty).count() == 0


def test_templates_learn_from_labels(spark):
    rows = [(f"http://h.org/shop/{i}", True) for i in range(40)] + [(f"http://h.org/shop/{i}", None) for i in range(40, 50)]
    rows += [(f"http://h.org/news/{i}.html", False) for i in range(40)] + [(f"http://h.org/news/{i}.html", None) for i in range(40, 50)]
    rows += [(f"http://h.org/wiki/{i}", False) for i in range(40)] + [(f"http://h.org/new{i}/x", None) for i in range(5)]
    rows += [(f"http://v.org/{chr(97 + i % 26)}word{chr(97 + i // 26)}/p", None) for i in range(60)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad boolean")
    got = {r.page_id: r for r in url_templates.judge(pages, label=F.col("bad")).collect()}
    by_url = {u: got[i] for i, (u, _) in enumerate(rows)}
    assert by_url["http://h.org/shop/45"].template == "/shop/{number}" and by_url["http://h.org/shop/45"].verdict == "block"
    assert by_url["http://h.org/news/45.html"].template == "/{alike}/{number}.html" or by_url["http://h.org/news/45.html"].template == "/news/{number}.html"
    assert by_url["http://h.org/news/45.html"].verdict == "allow"
    assert by_url["http://v.org/aworda/p"].template == "/*/{unlabelled}"


def test_url_filter_runs_without_python(spark):
    rows = QUERIES["op6_url_filter"](spark, SF)
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows.collect():
        host, _, rest = pages[r.page_id].split("://", 1)[1].partition("/")
        assert r.host == host.lower() and r.path == ("/" + rest if _ else "").split("?")[0].split("#")[0]


PAGES = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (7, "http://a/7", "same"), (3, "http://a/\r\n3", "x\r\n\r\nWARC/1.1\r\n\r\n"), (4, None, None), (5, "u", ""),
    (6, "u", "é\x00" * 3000), (8, "u", "dup"), (8, "u", "dup"), (None, "n", "same"), (None, "n", "only"),
]


@pytest.mark.parametrize("from_files", [False, True])
def test_archive_round_trip(spark, from_files):
    pages = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, record_type string")
    if from_files:
        path = shared_path(spark, "test-pages")
        pages.repartition(3).write.parquet(path)
        pages = spark.read.parquet(path)
    got = sorted(map(tuple, warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)
    want = []
    for id_, _, html in PAGES:
        data = (html or "").encode()
        first = max((p[0] for p in PAGES if (p[2] or "") == (html or "") and p[0] is not None), default=None)
        kind = "response" if id_ == first else "revisit"
        want.append((id_, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, first if kind == "revisit" else None))
    want[7] = (*want[7][:3], "revisit", 8)  # of the two equal rows one is the response
    assert got == sorted(want, key=repr)


def test_archive_records(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = shared_path(spark, "test-warc")
    warc.write_archives(pages, path, min_bytes=1, file_bytes=600)
    rows = warc.read_archives(spark, path, payloads=True).collect()
    assert sorted(r.html for r in rows if r.record_type == "response") == sorted(["", "", "dup", "only", "same", PAGES[3][2], PAGES[6][2]])
    assert {r.url for r in rows} >= {"http://a/%0D%0A3", None}
    assert len({r.page_id for r in rows if r.refers_to == 7}) == 3
    assert warc.round_trip(pages.limit(0)).count() == 0
    large = warc.round_trip(spark.createDataFrame([(1, "u", "ab" * 2_000_000)], "page_id long, url string, html string")).first()
    assert large.payload_bytes == 4_000_000


def test_archives_bounded_by_bytes(spark, tmp_path):
    """Files hold at most the stated bytes, or one record that is larger."""
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"), F.concat(F.repeat(F.lit("xy"), F.when(F.col("id") == 7, 50_000).otherwise(500)), F.col("id").cast("string")).alias("html")).repartition(2)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, file_bytes=20_000)
    files = [gzip.decompress(p.read_bytes()) for p in tmp_path.rglob("part-*.gz")]
    records = [list(warc.parse(iter([f]))) for f in files]
    assert sum(map(len, records)) == 300 and len(files) >= 20
    assert all(len(f) <= 21_000 or len(r) == 1 for f, r in zip(files, records))
    assert warc.read_archives(spark, path).count() == 300


def test_archives_stream(spark):
    """Records come out the same however the pieces are cut, also over several gzip members."""
    record = lambda i, n: f"WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: {i}\r\nContent-Length: {n}\r\n\r\n".encode() + b"\r\n" * (n // 2) + b"\r\n\r\n"
    data = b"".join(record(i, 2 * i) for i in range(40))
    for step in (1, 3, 1000):
        got = list(warc.parse(data[i : i + step] for i in range(0, len(data), step)))
        assert [(int(h["X-Page-ID"]), len(b)) for h, b in got] == [(i, 2 * i) for i in range(40)]
    zipped = gzip.compress(data) + gzip.compress(b"z" * 5_000_000)
    assert b"".join(warc._inflated(zipped)) == data + b"z" * 5_000_000
    with pytest.raises(ValueError, match="gzip"):
        list(warc._inflated(zipped[:-20]))
    for bad in (data[:-1], data[:20], b"HTTP\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse(iter([bad])))


@pytest.mark.parametrize("max_rows", [None, 0])
def test_archives_shuffle_headers_only(spark, max_rows):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    pages = pages.unionByName(pages.where("page_id % 3 = 0"))
    rows, heads, revisits = warc.resolve(pages)
    assert "html" not in heads.columns and "html" not in revisits.columns and revisits.count() > 0
    out = warc.responses(rows, heads, revisits, max_rows=max_rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert out.count() == pages.count() - revisits.count()


def test_archives_by_filter_equal_archives_by_broadcast(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    pages = pages.unionByName(pages.where("page_id % 3 = 0"))
    got = []
    for i, max_rows in enumerate((None, 0)):
        warc.write_archives(pages, str(tmp_path / str(i)), max_rows=max_rows)
        got.append(sorted(map(tuple, warc.read_archives(spark, str(tmp_path / str(i))).collect()), key=repr))
    assert got[0] == got[1] and len(got[0]) == pages.count()


def test_archives_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = con.execute(ORACLES["op10_archives"]).fetchall()
    got = QUERIES["op10_archives"](spark, SF)
    assert sorted(map(tuple, got.select(*[d[0] for d in con.description]).collect()), key=repr) == sorted(want, key=repr)
    assert set(names) <= {d[0] for d in con.description}
