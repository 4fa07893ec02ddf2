import hashlib
import random

from conftest import SF

from tastebud.llm import queries, warc

BIG = "<p>" + "payload " * 200
ROWS = [(1, "http://a.org/x", BIG), (5, "http://a.org/y", BIG), (3, "https://www.b.com:8080/q?a=1#f", BIG), (4, None, "small"), (6, "http://a.org/small", "small"),
        (7, "http://a.org/null", None), (8, "http://a.org/empty", ""), (9, "http://a.org/crlf\r\nX-Page-Id: 77", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nb\r\n"),
        (10, "http://ü.example/é", "é" * 700 + "\r\n\r\n\r\n"), (11, "x", "\r\n"), (12, "y", "\r"), (13, "z", "\n\r\n\r"), (14, "http://h/long", "l" * 3_000_000),
        (15, "", "é" * 500), (16, "q", "é" * 500), (17, "r", "é" * 499), (18, "r", "é" * 499), (20, "same", BIG + "2"), (20, "same", BIG + "2"), (19, "same", BIG + "2"), (None, "noid", BIG), (None, "noid", "x" * 1000), (None, "noid", "x" * 1000)]


def brute(rows):
    out = []
    groups = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000:
            groups.setdefault(b, []).append(p)
    for p, _, h in rows:
        b = (h or "").encode()
        ids = [x for x in groups.get(b, []) if x is not None]
        revisit = len(groups.get(b, [])) > 1 and bool(ids) and p != max(ids)
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", max(ids) if revisit else None))
    return sorted(out, key=str)


def through(spark, rows, tmp_path, **kw):
    df = spark.createDataFrame([(*r, "e", 1) for r in rows], "page_id long, url string, html string, digest string, bytes int").repartition(3)
    warc.write_archives(df, str(tmp_path / "w"), **kw)
    return warc.read_archives(spark, str(tmp_path / "w"))


def test_round_trip(spark, tmp_path):
    got = through(spark, ROWS, tmp_path)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == brute(ROWS)
    index = warc.CaptureIndex.build(got, block_lines=4)
    assert sorted((tuple(r) for r in index.lines().select(*cols).collect()), key=str) == brute(ROWS)
    assert sum(r.n for r in index.directory().collect()) == len(ROWS)


def test_random_terminators_in_payloads(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, f"http://h{i % 5}.net/{i}", "".join(rnd.choice(["\r", "\n", "\r\n", "a", "\r\n\r\n", "é", "WARC/1.1"]) for _ in range(rnd.randint(0, 40)))) for i in range(800)]
    got = through(spark, rows, tmp_path, min_bytes=1)
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in got.collect()} == {i: (len(h.encode()), hashlib.sha1(h.encode()).hexdigest()) for i, _, h in rows}


def test_archives_are_warc_files(spark, tmp_path):
    import glob
    import gzip
    through(spark, ROWS[:3], tmp_path)
    raw = b"".join(gzip.open(f).read() for f in glob.glob(str(tmp_path / "w" / "part-*")))
    assert raw.count(b"WARC/1.1\r\nX-Archive-Offset: ") == 3 and raw.count(b"WARC-Type: revisit") == 2 and raw.endswith(b"\r\n\r\n")


def test_captures_are_read_by_range(spark, tmp_path):
    got = through(spark, ROWS, tmp_path)
    index = warc.CaptureIndex.build(got, block_lines=4)
    lines = index.lookup([u for _, u, _ in ROWS if u])
    html = {p: h for p, _, h in ROWS}
    kept = {r.page_id for r in got.where("record_type = 'response'").collect()}
    read = warc.read_captures(lines).collect()
    assert {r.page_id for r in read} >= {p for p, u, _ in ROWS if u}
    for r in read:
        if r.page_id is not None:
            assert bytes(r.payload) == ((html[r.page_id] or "").encode() if r.page_id in kept else b"")


def test_large_archive_is_read_in_splits(spark, tmp_path):
    import os
    rnd = random.Random(5)
    rows = [(i, f"http://s.net/{i}", "%0512x" % rnd.getrandbits(2048)) for i in range(900)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).createOrReplaceTempView("one_file")
    warc.write_archives(spark.table("one_file"), str(tmp_path / "w"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records = warc.read_records(spark, str(tmp_path / "w"))
        got = {r.page_id: (r.payload_digest, r.start, r.length) for r in records.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {k: v[0] for k, v in got.items()} == {i: hashlib.sha1(h.encode()).hexdigest() for i, _, h in rows}
    sizes = [os.path.getsize(tmp_path / "w" / f) for f in os.listdir(tmp_path / "w") if f.startswith("part-")]
    # members and separators fill the files
    assert sum(v[2] for v in got.values()) + len(rows) * len(warc.SEPARATOR) == sum(sizes)


def test_find_a_table_of_captures(spark, tmp_path):
    rows = [(i, f"http://h{i % 7}.example.com/{i // 30}", f"text {i}") for i in range(600)] + [(7, "http://h0.example.com/0", "again"), (None, "http://h0.example.com/0", "none"), (3, None, "no url")]
    records = through(spark, rows, tmp_path)
    ask = [(u, p) for p, u, _ in rows[::17]] + [("http://h0.example.com/0", 7), ("http://h0.example.com/0", None), (None, 3), ("http://absent/", 1), ("http://h0.example.com/0", 999)]
    asked = spark.createDataFrame(ask * 2, "url string, page_id long")
    want = sorted(((warc.url_key(u), p) for p, u, _ in rows if (u, p) in set(ask)), key=str)
    for limit in (warc.MAX_DIRECTORY, 5, 1):  # a directory of every block, and of runs of blocks
        index = warc.CaptureIndex.build(records, block_lines=9, max_directory=limit)
        assert sorted(((r.url_key, r.page_id) for r in index.find(asked).collect()), key=str) == want
        assert sorted(r.page_id for r in index.lookup(["http://h3.example.com/10"]).collect()) == [p for p, u, _ in rows if u == "http://h3.example.com/10"]


def test_url_keys():
    for url, key in [("http://www.A.org:80/x?y", "org,a,www)/x?y"), ("https://a.org", "org,a)/"), ("http://u@b.c:81?q", "c,b:81)?q"), (None, ""), ("", ""), ("a.b/c", "b,a)/c")]:
        assert warc.url_key(url) == key


def test_lookup_reads_few_blocks(spark, tmp_path):
    rows = [(i, f"http://h{i % 7}.example.com/{i // 3}", f"text {i}") for i in range(1200)]
    index = warc.CaptureIndex.build(through(spark, rows, tmp_path), block_lines=25)
    for urls in (["http://h3.example.com/40"], ["http://h0.example.com/0", "http://h6.example.com/399", "http://none.example.com/"]):
        keys = {warc.url_key(u) for u in urls}
        assert sorted(r.page_id for r in index.lookup(urls).collect()) == sorted(i for i, u, _ in rows if warc.url_key(u) in keys)


def test_hot_payload_and_host(spark, tmp_path):
    rows = [(i, "http://hot.example/", BIG if i % 3 == 0 else f"own {i}") for i in range(1500)]
    got = through(spark, rows, tmp_path)
    assert got.where("record_type = 'revisit' AND refers_to = 1497 AND payload_bytes = %d" % len(BIG)).count() == 499


def test_empty_table(spark, tmp_path):
    got = through(spark, [], tmp_path)
    assert got.count() == 0 and warc.CaptureIndex.build(got).lines().count() == 0


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op7_warc(spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == brute(rows)
