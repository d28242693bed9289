"""Fingerprints, chat formatting, line dedup, sentence spans: against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from text_cases import ODD
from tillstar.llm import chat, fingerprints, lines, spans


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def passages(text: str | None) -> set[str]:
    return {p for p in re.split(r"\n|(?<=[.!?])\s+", text or "") if p}


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


# --- fingerprints ---


def test_next_document_and_likeness(odd):
    rows = fingerprints.with_next(odd)
    found = fingerprints.compare_versions(rows, "text", {"next": "next_text"}).collect()
    ordered = sorted(((i is not None, i or 0, t or "") for i, t in ODD))
    follows = Counter(
        ((i if known else None), t, ordered[(n + 1) % len(ordered)][2])
        for n, (known, i, t) in enumerate(ordered)
    )
    assert Counter((r.doc_id, r.text, r.next_text) for r in found) == follows
    for r in found:
        a, b = passages(r.text), passages(r.next_text)
        assert r.next_likeness == pytest.approx(jaccard(a, b))
        assert len(r.next_lost) == len(a - b) and len(r.next_only) == len(b - a)
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text, r.fingerprint) == r.fingerprint


def test_next_over_sparse_ids(spark, docs):
    ids = [0, 511, 512, 5_000, 10**7, 10**7 + 1, 3 * 10**9, -7]
    rows = fingerprints.with_next(docs(*[(i, f"t{i}") for i in ids])).collect()
    order = sorted(ids)
    want = {(a, f"t{b}") for a, b in zip(order, order[1:] + order[:1])}
    assert {(r.doc_id, r.next_text) for r in rows} == want


def test_large_differences_are_peeled_whole(spark):
    a = ".\n".join(f"left {i}" for i in range(900))
    b = ".\n".join(f"right {i}" if i % 3 else f"left {i}" for i in range(700))
    row = fingerprints.compare_versions(
        spark.createDataFrame([(a, b)], "a string, b string"), "a", {"b": "b"}
    ).first()
    x, y = passages(a), passages(b)
    assert (len(row.b_lost), len(row.b_only)) == (len(x - y), len(y - x))
    assert row.b_likeness == pytest.approx(jaccard(x, y))


def test_a_too_small_table_is_not_whole(spark):
    digests = F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.xxhash64(i))
    level = F.lit(0)
    peeled = fingerprints.peeled(fingerprints._subtable(digests, level), level)
    whole = fingerprints._peeled_apart(digests, F.array().cast("array<bigint>"))
    row = spark.range(1).select(peeled["whole"].alias("w"), F.size(whole).alias("n")).first()
    assert (row.w, row.n) == (False, 60)


def test_fingerprints_of_no_documents(empty):
    rows = fingerprints.with_next(empty)
    assert fingerprints.compare_versions(rows, "text", {"next": "next_text"}).collect() == []


# --- chat ---

TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "</s>[INST] ok [/INST]"),
    (1, 2, "assistant", r"a \ back\\slash <\/s> <</s>> [SYS][ROLE]"),
    (2, 1, "assistant", "second"), (2, 0, "user", None),
    (3, 0, "tool[TEXT]", "[/TEXT]x"), (3, 1, None, ""), (3, 1, "assistant", "línea\n😀"),
    (4, None, "user", "no turn"), (4, 0, "user", "b"), (4, 0, "user", "a"), (4, 0, "user", "a"),
    (None, 0, "assistant", "no id"),
]


def test_chat_reads_back_what_was_written(spark):
    turns = spark.createDataFrame(
        [(*t, "x", "y") for t in TURNS],
        "conv_id bigint, turn bigint, role string, text string, segments string, formatted string",
    )
    out = chat.format_conversations(turns).select(
        "conv_id", "n_turns", "is_valid", "formatted",
        chat.turns_of(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("learnt"),
    )
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, row in got.items():
        own = sorted(
            ((t is not None, t or 0, r or "", x or "") for c, t, r, x in TURNS if c == conv)
        )
        assert [(t.role, t.text) for t in row.turns] == [(r, x) for _, _, r, x in own]
        assert row.learnt == "".join(x for _, _, r, x in own if r == "assistant")
        assert row.n_turns == len(own)
    assert {c: r.is_valid for c, r in got.items()} == {
        1: True, 2: True, 3: False, 4: False, None: False
    }
    assert chat.format_conversations(turns.limit(0)).collect() == []


def test_chat_template_is_checked():
    with pytest.raises(ValueError):
        chat.ChatTemplate(
            {"user": chat.Turn("<<a>", "</a>")}, ("[R]", "[T]", "[/T]"), {}, "start", ()
        )


# --- lines ---


def brute_lines(rows, at_least):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(
        {c: c + 32 for c in range(65, 91)}
    )
    split = [(i, (t or "").split("\n")) for i, t in rows]
    seen = Counter(k for _, ls in split for k in {key(x) for x in ls} if k)
    out = []
    for i, ls in split:
        kept = [x for x in ls if seen[key(x)] < at_least]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("batches", [1, 9])
def test_line_dedup(docs, batches):
    rows = ODD + [(100 + i, f"own {i}\n  Common LINE\t\nÉ\n\ncommon line\nlast") for i in range(12)]
    rows += [(200, "é\nlast\ncommon line"), (201, "\n\n")]
    found = lines.drop_frequent_lines(docs(*rows), at_least=10, batches=batches)
    got = found.select("row.doc_id", "n_lines", "n_dropped", "kept", "row.fp").collect()
    assert Counter(tuple(r)[:4] for r in got) == brute_lines(rows, 10)
    assert {r.fp for r in got} == {"fp"}


def test_line_dedup_of_nothing(empty):
    assert lines.drop_frequent_lines(empty).collect() == []


def test_runs_are_compacted(spark, tmp_path):
    runs = lines.LineRuns(str(tmp_path), at_least=3, fan_in=2)
    for batch in range(5):
        runs.add(spark.range(20).selectExpr("id % 10 AS a", f"id % 10 + {batch} % 2 AS b"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.frequent().count() == 20


# --- sentence spans ---


def brute_sentences(text):
    marks = ".!?。！？．؟۔।"
    out = []
    for s in re.findall(rf"[^{marks}\n]+[{marks}\n]*[ \t\r\n]*|[{marks}\n]+[ \t\r\n]*", text or ""):
        words = re.findall(r"[ \t\r\n]*[^ \t\r\n]+[ \t\r\n]*|[ \t\r\n]+", s)
        parts = [""]
        for n, word in enumerate(words):
            parts[-1] += word
            key = brute_key(word)
            last = n == len(words) - 1
            if len(words) > 12 and not last and ((ord(key[0]) if key else 0) + len(key)) % 6 == 0:
                parts.append("")
        out += parts
    return out


def brute_key(sentence):
    lowered = sentence.translate({c: c + 32 for c in range(65, 91)})
    return re.sub("[ \t\r\n]+", " ", lowered).strip(" ")


def brute_spans(rows, size=3):
    pieces = {(i, t): brute_sentences(t) for i, t in rows}
    first, out = {}, Counter()
    order = sorted(pieces, key=lambda r: (r[0] is not None, r[0] or 0))
    spans_of = {}
    for r in order:
        keys = [brute_key(s) for s in pieces[r]]
        runs = max(len(keys) - size + 1, 1 if keys else 0)
        spans_of[r] = [tuple(keys[j : j + size]) for j in range(runs)]
        for j, s in enumerate(spans_of[r]):
            first.setdefault(s, (r[0], j))
    for (i, t) in rows:
        gone = set()
        met = set()
        for j, s in enumerate(spans_of[i, t]):
            if first[s][0] != i or s in met:
                gone.update(range(j, j + len(s)))
            met.add(s)
        kept = "".join(p for n, p in enumerate(pieces[i, t]) if n not in gone)
        out[i, len(pieces[i, t]), len(gone), kept] += 1
    return out


def test_sentence_spans(docs):
    passage = " ".join(f"word{i * i % 97}x{'y' * (i % 7)}" for i in range(51))
    shared = "Alpha beta gamma delta. Epsilon zeta eta theta! Iota kappa lambda mu? Nu xi."
    rows = ODD + [
        (20, "Start here. " + shared), (21, "Other. " + shared.upper() + " The end."),
        (22, shared.replace(". ", ".\n")), (23, "a. b. c. a. b. c."), (24, "a. b. c."),
        (25, "One. Two"), (26, "ONE.  two"), (27, "Before. One. Two"), (28, "第一。第二！第三？第四"),
        (29, "第一。第二！第三？"), (30, passage), (31, "Another start goes " + passage + " and an end"),
    ]
    found = spans.drop_repeated_spans(docs(*rows))
    got = found.select("row.doc_id", "n_sentences", "n_removed", "kept").collect()
    assert Counter(map(tuple, got)) == brute_spans(rows)
    removed = {r.doc_id: r.n_removed for r in got}
    assert all(removed[i] > 0 for i in (21, 22, 24, 26, 29, 31)) and removed[27] == 0


def test_sentences_put_together_are_the_text(odd):
    joined = F.array_join(spans.sentences(F.col("text")), "")
    assert odd.filter(joined != F.coalesce("text", F.lit(""))).count() == 0


def test_scan_finds_the_same_sentences(docs):
    texts = [
        "", "x" * 300_000, "word " * 100_000, ".", " . ", "\n \n", "a \n b", "a.\n \n. b\r\n c", "..a..",
        "第一。 第二！！\t第三", "one? two\x00three. four", "tail without a mark\u2028here", "! ! !",
    ]
    rows = docs(*ODD, *enumerate(texts, 100))
    slow, fast = (
        F.regexp_extract_all("text", F.lit(p), 0) for p in (spans.SENTENCE, spans.SENTENCE_SCAN)
    )
    assert rows.filter(~slow.eqNullSafe(fast)).count() == 0


def test_ascii_patterns_find_the_same_parts(docs):
    rng = random.Random(5)
    pick = lambda: rng.choice(["", "\t"]) + "".join(rng.choices("aBcZ09'(-", k=rng.randrange(1, 15)))
    texts = ["", " ", "word " * 20_000, "x" * 50_000, " \r " * 9 + "a", ".", "a.b. c.\n.\n d", " \n " * 20]
    texts += [" ".join(pick() for _ in range(n % 40)) + rng.choice(["", ". ", "\n", "!? "]) for n in range(200)]
    texts += ["".join(texts[9 + n : 14 + n]) for n in range(60)]
    rows = docs(*enumerate(texts))
    slow, fast = (
        F.regexp_extract_all("text", F.lit(p), 0) for p in (spans.SENTENCE, spans.ASCII_SENTENCE)
    )
    assert rows.filter(~slow.eqNullSafe(fast)).count() == 0
    got = rows.select("text", spans.sentences(F.col("text")).alias("s"))
    assert all(r.s == brute_sentences(r.text) for r in got.collect())


def test_sentence_spans_of_nothing(empty):
    assert spans.drop_repeated_spans(empty).collect() == []
