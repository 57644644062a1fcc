import random
from urllib.parse import unquote

import duckdb
import pytest

from tallyforge.llm import url_filter, warc
from tallyforge.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_warc", "op5_url_filter"])
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    found = QUERIES[name](spark, FOLDER)
    names = sorted(found.columns)
    expected = duck.execute(f"SELECT {', '.join(names)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(tuple, found.select(names).collect()), key=repr) == sorted(expected, key=repr)


def brute_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([k for k, c in enumerate(rest) if c in "/?#"], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = path[: min([k for k, c in enumerate(path) if c in "?#"], default=len(path))]
    fits = [
        (len(h) + len(p), len(h), h + p, a) for h, p, a in rules
        if None not in (h, p, a) and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_random_rules(spark):
    r = random.Random(2)
    name = lambda: ".".join(r.choice(["a", "B", "com", "é", ""]) for _ in range(r.randint(1, 4)))
    path = lambda: "".join(r.choice(["/", "x", "/x", "É", "//"]) for _ in range(r.randint(0, 4)))
    rules = {(name().lower(), path()): r.choice(["allow", "block"]) for _ in range(40)}
    rules = [(h, p, a) for (h, p), a in rules.items()] + [(None, "/", "block"), ("a", None, "block"), ("b", "/", None)]
    urls = [None, "", "com/x", "http://", "x://y://a/x", "http://COM\n/x"] + [f"http://{name()}{path()}{r.choice(['', '?q=/x', '#/x'])}" for _ in range(400)]
    rows = [(None if k % 50 == 0 else k, u, "h") for k, u in enumerate(urls)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, host string").repartition(5)
    table = spark.createDataFrame(rules, "host string, path string, action string")
    expected = sorted(((k, *brute_verdict(u, rules)) for k, u, _ in rows), key=repr)
    for limit in (200_000, 0):
        url_filter.BROADCAST_RULES = limit
        found = sorted((tuple(x) for x in url_filter.judge(df, table).collect()), key=repr)
        assert found == expected
    url_filter.BROADCAST_RULES = 200_000
    assert url_filter.judge(df.limit(0), table).count() == 0
    assert {x.verdict for x in url_filter.judge(df, table.limit(0)).collect()} == {"allow"}


def test_no_python_in_plan(spark):
    plan = QUERIES["op5_url_filter"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("block", [64, 1000, 8 << 20])
@pytest.mark.parametrize("small", [500_000, -1])
def test_archives(spark, tmp_path, monkeypatch, block, small):
    """Payloads full of what looks like records, split at any byte."""
    monkeypatch.setattr(warc, "BROADCAST_ROWS", small)
    fake = warc.page_record(99, "http://x", b"inner", None, "2024-01-01T00:00:00Z").decode()
    payloads = [None, "", fake, fake * 3, "WARC/1.1\r\nContent-Length: 5\r\n\r\nWARC/1.", "same é", "same é", "same é", "\r\n\r\n" * 50, "y" * 3000, "WARC/1.1\r\nContent-Length: " + "9" * 5000 + "\r\n\r\n"]
    rows = [(7 * k % 31, f"http://u/{k}\r\nX: y", p, "z") for k, p in enumerate(payloads)] + [(None, None, "same é", "z"), (None, None, "alone", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").coalesce(2)
    archives = warc.write_archives(df, f"{tmp_path}/w")
    found = {(r.page_id, r.payload_digest): r for r in warc.read_archives(spark, archives, block).collect()}
    assert len(found) == len(rows)
    for key, _, text, _ in rows:
        data = (text or "").encode()
        same = [k for k, _, t, _ in rows if (t or "") == (text or "") and k is not None]
        row = found[key, warc.base32_sha1(data)]
        first = min(same, default=None)
        refers = first if key is not None and key > first else None
        assert (row.payload_bytes, row.refers_to, row.record_type) == (len(data), refers, "revisit" if refers is not None else "response")
        assert row.payload is None if refers is not None else bytes(row.payload) == data


def test_archives_threshold_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    archives = warc.write_archives(df, f"{tmp_path}/a", least=3)
    assert sorted((r.page_id, r.refers_to) for r in warc.read_archives(spark, archives).collect()) == [(1, None), (2, None), (3, None), (4, 3)]
    assert warc.read_archives(spark, warc.write_archives(df.limit(0), f"{tmp_path}/b")).count() == 0


@pytest.mark.parametrize("block", [50_000, 8 << 20])
def test_long_urls(spark, tmp_path, block):
    """Headers longer than HEADER_BYTES, at the end of an archive too."""
    rows = [(k, "http://u/" + "é" * n, f"text {k}") for k, n in enumerate((3, 20_000, 0, 10_922, 10_700, 100_000))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(df, f"{tmp_path}/w")
    found = {r.page_id: (unquote(r.url), bytes(r.payload).decode()) for r in warc.read_archives(spark, archives, block).collect()}
    assert found == {k: (u, t) for k, u, t in rows}
