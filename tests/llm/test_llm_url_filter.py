from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from corpusflow.llm import url_filter
from corpusflow.llm.url_filter import RULES, judge_urls
from corpusflow.ship import ship_package

PAGES = "page_id long, url string, html string, rid long, gram string, n long, a long, r long, host string, score double"


def parts(url):
    host, path, body = "", "", url or ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host, tail = re.match(r"([^/?#]*)((?:.|\n)*)", rest).groups()
        host = "".join(c.lower() if c.isascii() else c for c in host)
        path, body = re.match(r"[^?#]*", tail)[0], host + tail
    return host, path, body


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(((-n, text, v) for n, text, v in fits), default=(0, None, None))[1:]


def plain(rows, order=4):
    """``(page_id, host, path, rule, verdict, score)`` with dictionaries of counts."""
    out = [(i, *parts(url), *rule(*parts(url)[:2])) for i, url in rows]
    held = lambda body: hashlib.md5(body.encode()).hexdigest()[0] < "4"
    pieces = lambda body: [p[i : i + order + 1] for p in ["\x02" * order + body + "\x03"] for i in range(len(body) + 1)] if body else []
    counts = {v: defaultdict(Counter) for v in ("allow", "block")}
    letters = set()
    for _, _, _, body, _, action in out:
        for g in pieces(body):
            letters.add(g[-1])
            if action and not held(body):
                for size in range(order + 1):
                    counts[action][g[order - size : order]][g[-1]] += 1
    if not all(counts.values()):
        return [(i, h, p, r, a or "allow", None) for i, h, p, _, r, a in out]

    def chance(model, g, size):
        if size < 0:
            return 1 / len(letters)
        seen = model[g[order - size : order]]
        shorter = chance(model, g, size - 1)
        return (seen[g[-1]] + len(seen) * shorter) / (seen.total() + len(seen)) if seen else shorter

    def steps(body):
        logs = [math.log(chance(counts["allow"], g, order)) - math.log(chance(counts["block"], g, order)) for g in pieces(body)]
        return math.floor(sum(math.floor(x * 2**20 + 0.5) if x >= 0 else -math.floor(-x * 2**20 + 0.5) for x in logs) / len(logs)) if logs else None

    scored = [(*row, steps(row[3])) for row in out]
    known = [(row[5], row[6] // 4096) for row in scored if row[5] and row[6] is not None and held(row[3])]
    allowed, blocked = (sum(a == v for a, _ in known) for v in ("allow", "block"))
    edges = sorted({b for _, b in known} | {b + 1 for _, b in known} | {0}) if allowed and blocked else [0]
    harm = lambda e: sum(b < e for a, b in known if a == "allow") * blocked + sum(b >= e for a, b in known if a == "block") * allowed
    edge = min(edges, key=lambda e: (harm(e), abs(e), e))
    return [(i, h, p, r, a or ("block" if s is not None and s < edge * 4096 else "allow"), None if s is None else s / 2**20) for i, h, p, _, r, a, s in scored]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, "x", 1, "g", 2, 3, 4, "h", 0.5) for i, u in rows], PAGES)


def urls():
    rows = [(i, f"https://{'casino' if i % 2 else 'news'}{i % 7}.example.{('com', 'net', 'org')[i % 3]}/{('de', 'en', 'fr')[i % 5 % 3]}/{i * 37 % 1000}") for i in range(240)]
    return rows


def odd():
    return [
        (900, None), (901, ""), (902, "no scheme"), (903, "://"), (904, "HTTP://EXAMPLE.Net/EN/1"), (905, "http://Example.NET/en/1?x#y"), (906, "http://net"), (907, "http://a.net?/"),
        (908, "http://xexample.com/de/1"), (909, "http://b.org/fr/漢\U0001f600é"), (910, "http://a.org/fr/://x.net/"), (None, "http://a.com/x\ny"), (911, "x" * 20_000), (912, "http://c.net/" + "ab" * 5_000),
        (5, "https://news5.example.org/fr/185"), (5, "https://news5.example.org/fr/185"),
    ]


def agrees(got, want):
    """Equal but for the last step of a score, which two libraries' logarithms may round apart."""
    got, want = ([tuple(r) for r in x] for x in (got, want))
    assert sorted((r[:5] for r in got), key=str) == sorted((r[:5] for r in want), key=str)
    for a, b in zip(*(sorted((r for r in x), key=lambda r: str(r[:5])) for x in (got, want)), strict=True):
        assert (a[5] is None) == (b[5] is None) and (a[5] is None or abs(a[5] - b[5]) < 1e-5)


@pytest.mark.parametrize("heavy", [1, 4096, 1 << 40])
def test_verdicts(spark, monkeypatch, heavy):
    """Whatever part of the stretches is joined by broadcast, the verdicts stay."""
    ship_package(spark)
    monkeypatch.setattr(url_filter, "HEAVY", heavy)
    rows = urls() + odd()
    found = judge_urls(frame(spark, rows)).collect()
    agrees(found, plain(rows))
    assert {r.verdict for r in found if r.rule is None} == {"allow", "block"}


def test_one_sided_and_empty_tables(spark):
    ship_package(spark)
    for rows in ([(1, "http://a.com/x"), (2, None)], [(1, "http://a.net/x"), (2, "http://b.com/y")], [(1, "http://a.org/fr/1")], []):
        agrees(judge_urls(frame(spark, rows)).collect(), plain(rows))


def test_models_part_what_rules_cannot(spark):
    """Hosts of a kind the rules block elsewhere are blocked where no rule reaches, others stay."""
    ship_package(spark)
    rows = [(i, f"http://casino-win{i}.example.net/") for i in range(60)] + [(100 + i, f"http://library{i}.example.org/fr/") for i in range(60)]
    rows += [(200 + i, f"http://casino-win{i}.example.info/xx/") for i in range(9)] + [(300 + i, f"http://library{i}.example.info/xx/") for i in range(9)]
    verdicts = {r.page_id: r.verdict for r in judge_urls(frame(spark, rows)).collect()}
    assert {verdicts[200 + i] for i in range(9)} == {"block"} and {verdicts[300 + i] for i in range(9)} == {"allow"}
