"""Decontamination, suffixes, SimHash and components: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from text_cases import ODD
from tillstar.llm import catalog, components, decontaminate, simhash, suffixes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


ITEMS = [
    (1, "the quick brown fox jumps over the lazy dog and then some more words"),
    (2, "short item"), (3, None), (4, "..."), (5, "short item"),
    (None, "Grüße aus Köln"), (10, "one two three four five six seven eight nine ten"),
]
TEXTS = ODD + [
    (30, "well, THE quick-brown fox; jumps over the lazy dog and then it ends"),
    (31, "a short   item, and a short item"), (32, "the quick brown fox jumps over the lazy"),
]


def brute_hits(text):
    own, hit, items = words(text), set(), set()
    for item, body in ITEMS:
        w = words(body)
        n = min(10, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                items.add("null" if item is None else str(item))
    return len(own), len(hit), tuple(sorted(items))


@pytest.mark.parametrize("block_bytes", [10**6, 60])
def test_contamination(spark, docs, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontaminate.find_contamination(docs(*TEXTS), items, block_bytes=block_bytes).collect()
    want = Counter((i, *brute_hits(t)) for i, t in TEXTS)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == want


def test_spans_point_into_the_text():
    automaton = decontaminate.build_automaton([("1", "Köln am Rhein")], 10)
    text = "Ä: KÖln! am--Rhein, Köln am  Rhein."
    assert decontaminate.scan(text, automaton)[3] == [(20, 34)]
    assert text[20:34] == "Köln am  Rhein"


def test_contamination_of_nothing(spark, empty, odd):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.find_contamination(empty, items).collect() == []
    assert decontaminate.find_contamination(odd, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


# --- suffixes ---


def brute_repeats(rows, size=suffixes.LENGTH):
    at: dict[bytes, int | None] = {}
    rank = lambda i: suffixes.NO_ID if i is None else i
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for q in range(len(b) - size + 1):
            s = b[q : q + size]
            at[s] = min(at.get(s, rank(i)), rank(i))
    out = Counter()
    for i, b in raw:
        gone = set()
        for q in range(len(b) - size + 1):
            if at[b[q : q + size]] < rank(i):
                gone.update(range(q, q + size))
        spans = sum(1 for j in gone if j - 1 not in gone)
        out[i, len(b), len(gone), spans, bytes(c for j, c in enumerate(b) if j not in gone)] += 1
    return out


def made_texts(seed):
    r = random.Random(seed)
    base = "".join(r.choice("abc déf") for _ in range(600))
    rows = []
    for i in range(25):
        parts = []
        for _ in range(r.randint(1, 6)):
            a = r.randrange(len(base))
            parts.append(base[a : a + r.randint(1, 120)] if r.random() < 0.7 else "z" * r.randint(1, 70))
        rows.append((r.randrange(12) if i % 4 else i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(docs, seed):
    rows = made_texts(seed) + (ODD if seed == 1 else [])
    found = suffixes.remove_repeats(docs(*rows)).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)
    assert got == brute_repeats(rows)


def test_repeats_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = Counter()
    for (i, size, gone, n_spans, kept), n in brute_repeats(rows).items():
        expected[i, size, gone, n_spans, hashlib.sha256(kept).hexdigest()] += n
    got = catalog.op5_suffixes(spark, sf_dir).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
    assert Counter(map(tuple, got.collect())) == expected


def test_repeats_of_nothing(empty):
    assert suffixes.remove_repeats(empty).collect() == []


def test_anchors_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    text = random.Random(3).randbytes(5000) + b"ab" * 900
    whole = suffixes.find_anchors(text)
    monkeypatch.setattr(suffixes, "CHUNK_BITS", 8)
    parts = suffixes.find_anchors(text)
    # the least hash is told by its high bits only, which are fewer with larger chunks
    assert (whole.at == parts.at).mean() > 0.99 if len(whole.at) == len(parts.at) else True
    assert parts.last[-1] == len(text) - suffixes.LENGTH


def test_merge_is_a_sort():
    r = random.Random(4)
    runs = []
    for n in (5, 0, 30, 1, 12):
        keys = sorted({(bytes(r.choice(b"ab") for _ in range(r.randint(20, 30))), b"x" * r.randrange(3))
                       for _ in range(n)})
        runs.append([suffixes.Suffix(right, left, 0, []) for right, left in keys])
    readers = [suffixes._Run(suffixes._front_coded(run)) for run in runs]
    out, before = [], b""
    for _, shared, run in suffixes.merged(readers):
        same = next((i for i, (x, y) in enumerate(zip(before, run.right)) if x != y),
                    min(len(before), len(run.right)))
        assert shared == same
        before = run.right
        out.append(run.right)
    assert out == sorted(s.right for run in runs for s in run)


# --- simhash ---


def brute_print(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate(
        {c: c + 32 for c in range(65, 91)})) if x]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints():
    for _, text in ODD:
        assert simhash.fingerprint(text) == brute_print(text)


def joined(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_links_join_what_brute_force_joins(spark):
    r = random.Random(7)
    prints = {r.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(r.randrange(5)):
            for bit in r.sample(range(64), r.randrange(1, 7)):
                p ^= 1 << bit
            prints.add(p)
    centre = r.getrandbits(64)
    prints |= {centre ^ (1 << i) for i in range(12)}  # more than three meet
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    near = [(a, b) for a in signed for b in signed if a < b and (a ^ b).bit_count() <= 4
            or a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    found = components.components(simhash.near_links(frame)).collect()
    assert {r.node: r.component for r in found} == joined(near)


def test_near_duplicates(docs, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by_id[4] == by_id[5] == 4
    assert by_id[1] == by_id[2] == by_id[3] == 1  # no words: fingerprint zero


def test_near_duplicates_of_nothing(empty):
    assert simhash.near_duplicates(empty).collect() == []


def test_components(spark):
    r = random.Random(9)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(150)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000), (5, None)]
    frame = spark.createDataFrame(links, "u bigint, v bigint")
    got = {r.node: r.component for r in components.components(frame).collect()}
    want = joined([(a, b) for a, b in links if b is not None and a != b])
    assert got == want
