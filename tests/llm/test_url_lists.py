from __future__ import annotations

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tallywork.llm import url_lists as ul
from tests.llm.conftest import tuples

START = date(2024, 1, 1)
ENTRY = "key string, action string, listed_on date"
CAPTURE = "page_id long, url string, fetched_on date, key string, action string, row int, host string"


def captures(llm, rows):
    return llm.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], CAPTURE)


def brute(rows, entries):
    """Replays every key's entries up to the day of each capture."""
    strictest = {a: i for i, a in enumerate(ul.ACTIONS)}
    state = {}
    for key, action, day in sorted((e for e in entries if None not in e and e[1] in strictest), key=lambda e: (e[2], -strictest[e[1]])):
        state.setdefault(key, []).append((day, action))
    out = []
    for page, url, day in rows:
        found = None
        host = (url or "").split("://")[-1].split("/")[0] if "://" in (url or "") else ""
        path = (url or "").split("://")[-1][len(host):].rstrip("/")
        labels = host.split(".")
        keys = ([host + path] if path else []) + [".".join(labels[i:]) for i in range(max(1, len(labels) - 1))]
        for key in keys if host and day else []:
            past = [(d, a) for d, a in state.get(key, []) if d <= day]
            if past and past[-1][1] != "drop":
                run = past[-1]
                for d, a in reversed(list(dict(past).items())):  # the last action of each day, back to where it began
                    if a != run[1]:
                        break
                    run = (d, a)
                found = (run[1], key, run[0])
                break
        out.append((page, host, day, *(found or ("none", None, None))))
    return sorted(out, key=repr)


def test_verdicts_against_a_replay(llm):
    rng = random.Random(5)
    hosts = ["a.b.example.com", "b.example.com", "example.com", "shop.example.org", "example.org", "localhost"]
    rows = [(i, f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/p', '/q/r/'])}", START + timedelta(rng.randrange(40))) for i in range(400)]
    rows += [(1, rows[1][1], rows[1][2]), (None, "http://example.com/p", START), (500, None, START), (501, "no url", START), (502, "http://example.com", None)]
    entries = [(rng.choice([*hosts, "example.com/p", "b.example.com/q/r", "com"]), rng.choice([*ul.ACTIONS, "unknown", None]), START + timedelta(rng.randrange(40))) for _ in range(120)]
    entries += [(None, "block", START), ("example.org", "block", None), *entries[:5]]
    got = ul.judge(captures(llm, rows), llm.createDataFrame(entries, ENTRY))
    assert tuples(got) == brute(rows, entries)


def test_intervals_close_at_the_next_change(llm):
    d = [START + timedelta(i) for i in range(6)]
    entries = [("k", "block", d[0]), ("k", "block", d[1]), ("k", "allow", d[3]), ("k", "drop", d[3]), ("k", "drop", d[5])]
    got = ul.intervals(llm.createDataFrame(entries, ENTRY))
    assert tuples(got, "action", "valid_from", "valid_to") == [("allow", d[3], d[5]), ("block", d[0], d[3]), ("drop", d[5], None)]


def test_hosts_and_keys(llm):
    urls = ["HTTPS://User:pw@WWW.Example.COM.:8080/A/?q#f", "http://x.y.z/", "ftp://host", "mailto:a@b", "", None, "http:///p", "http://h?q=/x"]
    got = [tuple(r) for r in llm.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").orderBy("i").select(ul.host(F.col("u")), ul.keys(F.col("u"))).collect()]
    assert got == [
        ("www.example.com", ["www.example.com/A", "www.example.com", "example.com"]), ("x.y.z", ["x.y.z", "y.z"]), ("host", ["host"]),
        ("", []), ("", []), ("", []), ("", []), ("h", ["h"]),
    ]


def test_one_host_with_most_captures(llm):
    rows = [(i, f"http://hot.example.com/{i}", START + timedelta(i % 3)) for i in range(3000)]
    got = ul.judge(captures(llm, rows), llm.createDataFrame([("example.com", "block", START + timedelta(1))], ENTRY))
    assert {(r.verdict, r["count"]) for r in got.groupBy("verdict").count().collect()} == {("none", 1000), ("block", 2000)}


def test_empty_tables(llm):
    none = llm.createDataFrame([], ENTRY)
    assert ul.judge(captures(llm, []), none).count() == 0
    assert tuples(ul.judge(captures(llm, [(1, "http://a.b", START)]), none), "verdict") == [("none",)]
