"""Fill-in-the-middle, filter audit and URL filters: against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from text_cases import ODD
from tillstar.llm import audit, infill, urls
from tillstar.llm.catalog import URL_RULES


# --- fill in the middle ---

MARKED = [(30, "has <P> inside"), (31, "<S>"), (32, "ends with <M"), (33, "<"), (34, "a<P<S>")]
MANY = [(i, f"Word {i}, second 日本 line\n<b>é</b> <P {i} S> end") for i in range(40, 140)]


def brute_infill(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(docs):
    rows = ODD + MARKED + MANY
    out = infill.fill_in_middle(docs(*rows)).withColumn(
        "restored", infill.restored(F.col("output"), F.col("form"))
    ).collect()
    assert Counter(tuple(r)[:6] for r in out) == Counter(brute_infill(*r) for r in rows)
    assert Counter((r.doc_id, r.restored) for r in out) == Counter((i, t or "") for i, t in rows)
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_a_very_long_text(docs):
    text = "日 本 ab cd. " * 250_000
    row = infill.fill_in_middle(docs((5, text))).select(
        "n_units", (infill.restored(F.col("output"), F.col("form")) == text).alias("whole")
    ).first()
    assert row.whole and row.n_units == len(re.findall("[A-Za-z]+|[^A-Za-z]", text))


def test_fill_in_middle_of_nothing(empty):
    assert infill.fill_in_middle(empty).collect() == []


@pytest.mark.parametrize("share", [0.0, 0.001, 0.05, 0.5, 0.999])
def test_boundaries_by_rank(share):
    marks = np.random.default_rng(3).random(200_000) < share
    marks[70_000:90_000] = True  # a run across two blocks
    marks[131_072:196_608] &= share > 0.5  # a block that is empty for small shares
    found, want = infill.BoundarySet(marks), np.flatnonzero(marks)
    assert len(found) == len(want)
    for rank in {0, len(want) - 1, *random.Random(1).choices(range(len(want)), k=2000)}:
        assert found.select(rank) == want[rank]
    for rank in (-1, len(want)):
        with pytest.raises(IndexError):
            found.select(rank)


def test_all_kinds_of_containers():
    kinds = {
        type(c).__name__
        for text in ("a b " * 50_000, "日本" * 50_000, "letters " * 50_000)
        for c in infill.unit_bounds(text).containers
    }
    assert kinds == {"ArrayContainer", "BitmapContainer", "RunContainer"}


def test_marks_that_cannot_be_told_apart():
    for marks in (("<P>", "<P>", "<M>"), ("<P>", "x<", "<M>"), ("ab", "ba", "c!")):
        with pytest.raises(ValueError):
            infill.Infill(*marks)


# --- filter audit ---


def brute_audit(rows, labels):
    """rows: (id, text, part); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failing = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = i is not None and any(
            j is not None and j < i and (other or "") == text for j, other, _ in rows
        )
        bad = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": copy,
        }
        failing.append((part or "", i, {f for f in bad if bad[f]}))
    out = {}
    for part in {p for p, _, _ in failing}:
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = [(i, f) for p, i, f in failing if p == part]
            gone = []
            for step, f in enumerate(order, 1):
                lost = [i for i, bad in left if f in bad]
                redundant = sum(f in bad for _, bad in gone)
                gone += [(i, bad) for i, bad in left if f in bad]
                left = [(i, bad) for i, bad in left if f not in bad]
                shapley[f] += len(lost)
                unique = sum(bad == {f} for p, _, bad in failing if p == part)
                out[part, "".join(order), step] = [
                    len(left), len(lost), redundant, unique, sum(i in good for i in lost),
                    sum(i in toxic for i in lost), f,
                ]
        for (p, _, _), row in out.items():
            if p == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_audit(spark):
    words = " ".join(f"w{i}" for i in range(120))
    texts = [None, "", " \t", "SHOUT it", "a # b", words, words + " $", "Word " * 200, "it|IT " * 60,
             words.upper(), "x\x0by\x1cz" * 40, "ÀÉ É\xa0é " * 30]
    rng = random.Random(4)
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(80)]
    rows += [rows[3], (None, words, "en"), (None, words, "en"), (None, None, "fr"), (-5, words, "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 80, 2)]
    labels += [(2, 1, 0), (2, 0, 0), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame(
        [(*r, "x", 1, "y") for r in rows],
        "doc_id bigint, text string, lang string, part string, mask int, digest string",
    ).repartition(5)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = audit.interactions(audit.failure_counts(docs, known)).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in found}
    assert len(got) == len(found) == 4 * 600
    assert got == brute_audit(rows, labels)
    none = audit.interactions(audit.failure_counts(docs, known.limit(0)))
    assert none.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def test_filter_audit_of_nothing(spark, empty):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert audit.interactions(audit.failure_counts(empty, labels)).collect() == []


def test_paths_reach_and_leave_every_state():
    reach, leave = audit.paths(5)
    for state in range(32):
        size = state.bit_count()
        assert reach[state] == math.factorial(size) and leave[state] == math.factorial(5 - size)


# --- URL filters ---

NAMES = ["alpha", "beta", "Gamma", "delta", "epsilon", "zeta", "kappa"]


def some_urls():
    rng = random.Random(9)
    out = [
        None, "", "no scheme here", "://", "http://", "x://net", "http://NET/", "http://net?x",
        "https://a.b.net/", "https://Net.example.net/en", "https://example.NET/en/",
        "http://example.net/en/#a://b/c", "http://myexample.net/en/1", "http://org/fr/", "http://org/fr",
        "http://a.example.com/de/x?y", "ftp://example.com/De/", "http://日本.example.org/ü/é?ñ",
        "http://a.net:80/x", "net/", "example.net/en/", "http://long.example.org/" + "path/" * 3000,
    ]
    for _ in range(150):
        host, tld = rng.choice(NAMES), rng.choice(["com", "net", "org"])
        word = rng.choice(["sale", "buy"]) if tld == "net" else rng.choice(["news", "text"])
        path = f"{rng.choice(['en', 'de', 'fr'])}/{word}{rng.randrange(50)}"
        out.append(f"https://{host}.example.{tld}/{path}{rng.choice(['', '?q=1', '#top', '/'])}")
    return out


def brute_urls(all_urls):
    lower = str.maketrans({c: c + 32 for c in range(65, 91)})
    parsed = []
    for url in all_urls:
        text = url or ""
        if "://" in text:
            rest = text.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0]
            path = re.match("[^?#]*", rest[len(host):])[0]
            address = host.translate(lower) + rest[len(host):]
            host = host.translate(lower)
        else:
            host, path, address = "", "", text
        fits = [
            r for r in URL_RULES
            if ("." + host).endswith("." + r.host) and path.startswith(r.path)
        ]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        parsed.append((host, path, address, rule))
    taught = {(a, r.verdict if r else None) for _, _, a, r in parsed}

    def held(a):
        return int(hashlib.md5(a.encode()).hexdigest()[:8], 16) % 5 == 0

    def grams(a):
        padded = "\x02" * 4 + a + "\x03"
        return [padded[i : i + 5] for i in range(len(a) + 1)]

    def model(label, whole):
        seen = defaultdict(Counter)
        for a, verdict in taught:
            if verdict == label and (whole or not held(a)):
                for g in grams(a):
                    for k in range(5):
                        seen[g[4 - k : 4]][g[4]] += 1

        def estimate(gram, k=4):
            shorter = estimate(gram, k - 1) if k else 1 / 256
            found = seen.get(gram[4 - k : 4])
            if not found:
                return shorter
            return (found[gram[4]] + len(found) * shorter) / (found.total() + len(found))

        return estimate

    def score(a, whole):
        allow, block = (model(v, whole) for v in ("allow", "block"))
        nats = sum(
            math.floor((math.log(allow(g)) - math.log(block(g))) * 1e6 + 0.5) for g in grams(a)
        )
        return max(-20000, min(20000, math.floor(nats / (1000 * len(grams(a))))))

    sides = {v: [score(a, False) for a, w in taught if w == v and held(a)] for v in ("allow", "block")}
    points = sorted({s for side in sides.values() for s in side})

    def errors(t):
        missed = sum(s < t for s in sides["allow"]) * len(sides["block"])
        return missed + sum(s >= t for s in sides["block"]) * len(sides["allow"])

    threshold = min(points, key=lambda t: (errors(t), abs(t), t))
    free = {a: score(a, True) for a, verdict in taught if verdict is None}
    return [
        (h, p, r.name, r.verdict, None) if r
        else (h, p, None, "allow" if free[a] >= threshold else "block", free[a])
        for h, p, a, r in parsed
    ]


def test_url_filters(spark):
    own = some_urls()
    own += own[30:60]  # repeated rows
    pages = spark.createDataFrame(
        [(i if i % 50 else None, u, "h", 0.5, "r") for i, u in enumerate(own)],
        "page_id bigint, url string, host string, score double, rule string",
    ).repartition(4)
    found = urls.judge_urls(pages, URL_RULES).select(
        "row.page_id", "row.url", "host", "path", "rule", "verdict", "score"
    ).collect()
    want = Counter(
        (i if i % 50 else None, u, *w) for i, (u, w) in enumerate(zip(own, brute_urls(own)))
    )
    assert Counter(map(tuple, found)) == want
    assert {r.verdict for r in found if r.rule is None} == {"allow", "block"}


def test_frequent_grams_change_nothing(spark, monkeypatch):
    pages = spark.createDataFrame([(u,) for u in some_urls()], "url string")
    usual = urls.judge_urls(pages, URL_RULES).select("row.url", "verdict", "score").collect()
    monkeypatch.setattr(urls, "HOT_SHARE", 50)
    again = urls.judge_urls(pages, URL_RULES).select("row.url", "verdict", "score").collect()
    assert Counter(usual) == Counter(again)


def test_urls_without_both_kinds_of_rules(spark):
    pages = spark.createDataFrame([("http://a.org/fr/1",), ("http://b.com/x",), (None,)], "url string")
    found = urls.judge_urls(pages, URL_RULES).select("rule", "verdict", "score").collect()
    assert Counter(map(tuple, found)) == Counter({("org/fr/", "allow", None): 1, (None, "allow", None): 2})
    assert urls.judge_urls(pages.limit(0), URL_RULES).collect() == []
