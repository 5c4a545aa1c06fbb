import random

import pytest
from pyspark.sql import functions as F

from docquarry.llm import revisits

SCHEMA = ("record_id long, url string, date long, revisit boolean, etag string, last_modified long, "
          "headers map<string,string>, verdict string, range int")


@pytest.mark.parametrize("url,expected", [
    ("HTTP://www.Ex.com:80/A/?utm_source=x&b=1&ref=y#top", "ex.com/A/?b=1"), ("https://ex.com/a/", "ex.com/a"),
    ("ex.com", "ex.com"), ("https://ex.com/?fbclid=1", "ex.com"), ("", ""), ("http://m.ex.com/a.html?x=1&&y=2", "m.ex.com/a.html?x=1&y=2")])
def test_canonical(spark, url, expected):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(revisits.canonical(F.col("url")).alias("u")).first().u == expected


def brute(rows):
    out = []
    for r in rows:
        i, url, date, revisit, etag, modified, headers = r[:7]
        if revisit is False:
            continue
        best = None
        for o in rows:
            if o[3] is False and None not in (url, o[1], date, o[2]) and o[1] == url and o[2] < date:
                if best is None or (o[2], o[0] is not None, o[0] or 0) >= (best[2], best[0] is not None, best[0] or 0):
                    best = o
        strip = lambda t: t and t.removeprefix("W/")
        if best is None:
            verdict = "no response"
        elif etag is not None:
            verdict = "resolved" if strip(etag) == strip(best[4]) else "etag differs"
        elif modified is not None:
            verdict = "resolved" if modified == best[5] else "date differs"
        else:
            verdict = "unchecked"
        merged = dict(headers or {})
        if verdict in ("resolved", "unchecked") and best[6] is not None:
            merged = {**best[6], **{k: v for k, v in (headers or {}).items() if k in revisits.PERMITTED}}
        out.append((i, best and best[0], verdict, sorted(merged.items())))
    return sorted(out, key=repr)


def records(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        url = rng.choice(["a.com/1"] * 5 + [f"a.com/{rng.randrange(6)}", None])
        headers = rng.choice([None, {}, {"etag": "n", "server": f"s{i}"}, {"date": str(i), "x": "y"}])
        rows.append((i, url, rng.choice([None, *range(40)]), rng.choice([True, True, False, None]),
                     rng.choice([None, '"a"', 'W/"a"', '"b"']), rng.choice([None, 1, 2]), headers, "x", 1))
    return rows


def got(spark, rows, parts=5):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(((r.record_id, r.refers_to, r.verdict, sorted((r.headers or {}).items()))
                   for r in revisits.resolve(frame).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = records(seed)
    assert got(spark, rows) == brute(rows)


def test_one_url_over_many_ranges_repeats_and_empty(spark):
    rows = [(i, "a.com", i, i % 50 != 0, '"t"' if i % 2 else None, None, {"date": str(i)}, "x", 1) for i in range(400)]
    assert got(spark, rows) == brute(rows)
    twice = rows + [rows[7]]
    assert len(got(spark, twice)) == len(brute(twice)) and revisits.resolve(
        spark.createDataFrame([], SCHEMA)).collect() == []
