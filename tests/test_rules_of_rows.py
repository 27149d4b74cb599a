"""First-wins rules, routes and folds against sequential models."""

import random

from pyspark.sql import functions as F

from tidewire.operators import classify as C
from tidewire.operators import crawl, crumbs, dedup, failures, index


def test_history_order(spark):
    rows = [("f", 1, "http://u1.org/", "x"), ("f", 2, "http://u1.org/", "1"), ("f", 3, "http://u1.org/", "2"), ("f", 4, "http://u1.org/", "x"), ("f", 5, "http://u2.org/", "3"), ("g", 6, "http://u1.org/", "4")]
    df = spark.createDataFrame(rows, "file string, pos int, url string, dlid string")
    got = [r["disposition"] for r in dedup.dedup_urls_history(df).orderBy("pos").collect()]
    assert got == ["bad-dlid", "queuing", "dups", "dups", "queuing", "queuing"]


def test_history_against_a_model(spark):
    rng = random.Random(1)
    urls = ["http://a.org/", "http://b.org/", "http://localhost/", "", "http://[x/"]
    rows = [(str(rng.randint(0, 2)), i, rng.choice(urls), rng.choice(["1", "x"])) for i in range(300)]
    seen, want = set(), []
    for f, i, u, d in rows:
        s = "bad-url" if u in ("", "http://[x/") else "dups" if (f, u) in seen else "bad-host" if "localhost" in u else "queuing" if d == "1" else "bad-dlid"
        if s == "queuing":
            seen.add((f, u))
        want.append(s)
    df = spark.createDataFrame(rows, "file string, pos int, url string, dlid string")
    assert [r["disposition"] for r in dedup.dedup_urls_history(df).orderBy("pos").collect()] == want


def test_fetch_status(spark):
    cases = [
        (404, None, None, b"x", "http-404", "discard"), (429, None, None, b"x", "http-429", "retry"), (503, None, None, b"x", "http-5xx", "retry"), (501, None, None, b"x", "http-5xx", "discard"),
        (200, "image/png", None, b"x", "not-text", "discard"), (200, "image/png", "utf-8", b"x", "success", "pass"), (200, None, None, b"", "no-html", "discard"), (200, "", None, b"x" * 11, "oversized", "discard"),
        (301, None, None, b"x", "http-3xx", "discard"),
    ]
    df = spark.createDataFrame([(i, *c[:4], None) for i, c in enumerate(cases)], "i int, status int, content_type string, encoding string, body binary, error_class string")
    got = [(r["disposition"], r["action"]) for r in C.classify_fetch(df, most=10).orderBy("i").collect()]
    assert got == [c[4:] for c in cases]


def test_retries(spark):
    rows = [(1, "retry", 9, None), (2, "retry", 10, None), (3, "retry", 10, "gone"), (4, "requeue", 3, None), (5, "quarantine", 5, None), (6, "ok", 1, None)]
    df = spark.createDataFrame(rows, "i int, action string, retries int, error_class string")
    now = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    out = failures.route_failures(df, now, discard=("gone",)).orderBy("i").collect()
    assert [(r["dest"], r["next_retries"]) for r in out] == [("retry", 10), ("quarantine", 0), ("discard", 10), ("requeue", 3), ("quarantine", 0), ("done", 1)]
    assert [r["available_at"].strftime("%H:%M") if r["available_at"] else None for r in out] == ["01:00", None, None, "00:02", None, None]


def test_paced_release(spark):
    rng = random.Random(3)
    rows = sorted((rng.choice("ab"), rng.uniform(0, 60), i) for i in range(80)) + [("c", 0.0, 90), ("c", 0.0, 91), ("c", 0.0, 92), ("c", 20.0, 93)]
    free, want = {}, {}
    for h, a, i in sorted(rows, key=lambda r: (r[1], r[2])):
        want[i] = max(a, free.get(h, 0.0))
        free[h] = want[i] + 5
    got = {r["i"]: r["issued_at"] for r in crawl.paced_release(spark.createDataFrame(rows, "h string, a double, i int"), "h", "a", 5.0, ("i",)).collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)
    assert [got[i] for i in (90, 91, 92, 93)] == [0, 5, 10, 20]


def test_interval_fold():
    cfg, avg, blocked = crawl.Pacing(), 0.0, 0.0
    seen = []
    for outcome, seconds, at in (("DATA", 40, 0), ("NODATA", 8, 1), ("DATA", 8, 2), ("NOCONN", 0, 3), ("THROTTLE", 0, 4)):
        avg, blocked = crawl.fold(avg, blocked, outcome, seconds, at, cfg)
        seen.append((round(avg, 3), blocked))
    assert seen == [(40, 0), (40, 0), (32, 0), (32, 603), (round(32 * 2 ** (1 / 8), 3), 603)]


def greedy(sizes, n):
    filled, out = [0] * n, []
    for size in sizes:
        least = filled.index(min(filled))
        filled[least] += size
        out.append(least)
    return out, filled


def test_deal_is_the_greedy_rule():
    rng = random.Random(7)
    for _ in range(500):
        n = rng.randint(1, 6)
        sizes = sorted((rng.choice([1, 1, 2, 3, 7, 40]) for _ in range(rng.randint(0, 80))), reverse=True)
        filled, got = [0] * n, []
        for size in sorted(set(sizes), reverse=True):
            starts, turns = crawl.deal(filled, size, sizes.count(size))
            assert len(starts) <= n
            for rank in range(sizes.count(size)):
                run = sum(x <= rank for x in starts) - 1
                got.append(turns[run][(rank - starts[run]) % len(turns[run])])
        assert (got, filled) == greedy(sizes, n)


def test_packing_is_greedy_for_small_domains_too(spark):
    rng = random.Random(8)
    names = ["big"] * 4000 + ["mid"] * 900 + [f"d{i}" for i in range(900) for _ in range(rng.randint(1, 3))]
    rng.shuffle(names)
    first, stories = {}, {}
    for i, name in enumerate(names):
        first.setdefault(name, i)
        stories[name] = stories.get(name, 0) + 1
    order = sorted(stories, key=lambda d: (-stories[d], -first[d]))
    want = dict(zip(order, greedy([stories[d] for d in order], 3)[0]))
    out = crawl.pack_domains(spark.createDataFrame(list(zip(names, range(len(names)))), "domain string, pos int").repartition(7), 3).collect()
    assert {r["domain"]: r["batch"] for r in out} == want and len(out) == len(want)


def test_packing(spark):
    rows = [("b", 0), ("c", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 5), ("c", 6)]
    out = crawl.pack_domains(spark.createDataFrame(rows, "domain string, pos int"), 2).collect()
    assert {r["domain"]: r["batch"] for r in out} == {"a": 0, "c": 1, "b": 1}


def test_packing_of_many_small_domains(spark, monkeypatch):
    monkeypatch.setattr(crawl, "HEAD", 2)
    rows = [(f"d{i}", i) for i in range(3000)] + [("big", 5000 + i) for i in range(500)]
    out = crawl.pack_domains(spark.createDataFrame(rows, "domain string, pos int"), 4).collect()
    filled = [sum(r["stories"] for r in out if r["batch"] == k) for k in range(4)]
    assert len(out) == 3001 and sum(filled) == 3500 and all(abs(f - 875) < 120 for f in filled)


def test_crumbs(spark):
    header, new = '{"version":[1,0,0],"app":"p"}', '{"version":[2,0],"app":"p"}'
    line, broken, lone = '{"date":"d","status":"s"}', "{x", '{"date":"d","app":"q","status":"s","count":3}'
    df = spark.createDataFrame([(1, f"{header}\n{line}\n{broken}\n{lone}"), (2, f"{new}\n{lone}"), (3, lone), (4, f"{broken}\n{header}\n{line}")], "m int, body string")
    got = {(r["m"], r["header"], r["app"], r["counted_app"], r["count"]) for r in crumbs.read_crumbs(df).collect() if r["kind"] == "crumb"}
    assert got == {(1, "vers-ok", "q", "q", 3), (1, "vers-ok", None, "p", 1), (3, "no-vers", "q", "q", 3), (4, "vers-ok", None, "p", 1)}
    kinds = {(r["m"], r["kind"]) for r in crumbs.read_crumbs(df).collect()}
    assert (2, "too-new") in kinds and (2, "crumb") not in kinds and (1, "bad") in kinds and (4, "bad") in kinds


def test_upsert_and_prune_treat_null_as_the_rules_say(spark):
    rows = [("2024-01-0%d" % d, f, 1, None, "a", "s", 1) for f in (1, None) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "date string, feed_id long, source_id long, domain string, app string, status string, count long")
    both = crumbs.crumb_upsert(df, df)
    assert both.count() == 6 and {r["count"] for r in both.collect()} == {2}
    left = crumbs.prune_crumbs(df, 2)
    assert sorted((r["feed_id"] or 0, r["date"]) for r in left.collect()) == [(0, "2024-01-01"), (0, "2024-01-02"), (0, "2024-01-03"), (1, "2024-01-02"), (1, "2024-01-03")]
    assert tuple(crumbs.prune_summary(df, 2).first()) == (2, 1, 1, 1)


def test_dates(spark):
    rows = [(1, None, "Sun, 30 Apr 2023 23:30:00 -0500"), (2, "None", None), (3, "", "junk"), (4, "2024-01-02", "junk"), (5, None, "Mon, 1 May 2023 01:00:00 GMT")]
    df = spark.createDataFrame(rows, "i int, publication_date string, pub_date string")
    got = [(r["publication_date"], r["pub_date_status"]) for r in index.resolve_pub_date(df).orderBy("i").collect()]
    assert got == [("2023-04-30", "rss"), (None, "none"), (None, "retry"), ("2024-01-02", "extracted"), (None, "retry")]
