"""Substring dedup by sliding spans of sentences."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.tables import lower_ascii, written

SPAN = 3
#: Sentences of more words are cut by their content.
LONG_SENTENCE = 12

#: Marks that end a sentence: Latin, full-width and ideographic, Arabic, Devanagari.
MARKS = ".!?。！？．؟۔।"
#: A sentence ends with marks or a line end and has the white space behind it.
SENTENCE = rf"[^{MARKS}\n]+[{MARKS}\n]*[ \t\r\n]*|[{MARKS}\n]+[ \t\r\n]*"
#: The same, found by looking for the marks: Java is slow at "none of these" with marks beyond Latin.
SENTENCE_SCAN = rf"(?s).*?[{MARKS}\n]+[ \t\r\n]*|.+"
#: The same for texts of ASCII characters.
ASCII_SENTENCE = r"[^.!?\n]*+[.!?\n]++[ \t\r\n]*+|[^.!?\n]++"
WORD = r"[ \t\r\n]*[^ \t\r\n]+[ \t\r\n]*|[ \t\r\n]+"


def _ascii_part() -> str:
    """A pattern for the parts of a sentence of ASCII characters, as :func:`_cut` has them.

    A picked word starts with a letter of one of six classes and has the length that goes with it.
    Nothing in it is tried twice.
    """
    blank, letter = r"[ \t\r\n]", r"[^ \t\r\n]"
    picked = []
    for c in range(6):
        codes = [i for i in range(128) if ord(chr(i).lower()) % 6 == c and chr(i) not in " \t\r\n"]
        first = "".join(f"\\x{i:02x}" for i in codes)
        picked.append(f"[{first}]{letter}{{{5 - c}}}(?:{letter}{{6}})*+(?!{letter})")
    ends = f"(?:{'|'.join(picked)})"
    word = rf"{letter}++{blank}*+"
    short = rf"\A{blank}*+(?:{word}){{1,{LONG_SENTENCE}}}+\z"
    return rf"{short}|{blank}*+(?:(?:(?!{ends}){word})*+{ends}{blank}*+|(?:{word})++)|{blank}++"


#: Short sentences as they are, long ones in parts, the characters being ASCII.
ASCII_PART = _ascii_part()


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cut(sentence: Column) -> Column:
    """A sentence, or its parts if it is long: each ends with a word that its content picks.

    The first code point and the length of a word pick one word in six, so the parts inside a
    passage are the same wherever in a sentence the passage starts.
    """

    def ends_part(word: Column) -> Column:
        def picked(plain: Column) -> Column:
            first = F.ascii(plain)
            lowered = F.when(first.between(65, 90), first + 32).otherwise(first)
            return (lowered + F.char_length(plain)) % 6 == 0

        return _let(F.btrim(word, F.lit(" \t\r\n")), picked)

    def parts(words: Column) -> Column:
        last = F.size(words)
        ends = F.filter(
            F.sequence(F.lit(1), last), lambda i: (i == last) | ends_part(F.get(words, i - 1))
        )

        def of_ends(e: Column) -> Column:
            def part(end: Column, i: Column) -> Column:
                start = F.when(i == 0, 0).otherwise(F.get(e, i - 1))
                return F.array_join(F.slice(words, start + 1, end - start), "")

            return F.transform(e, part)

        return _let(ends, of_ends)

    words = F.regexp_extract_all(sentence, F.lit(WORD), 0)
    cut = _let(
        words,
        lambda w: F.when(F.size(w) <= LONG_SENTENCE, F.array(sentence)).otherwise(parts(w)),
    )
    fast = F.regexp_extract_all(sentence, F.lit(ASCII_PART), 0)
    # so few characters cannot be more words than that
    return (
        F.when(F.char_length(sentence) <= 2 * LONG_SENTENCE, F.array(sentence))
        .when(F.char_length(sentence) == F.octet_length(sentence), fast)
        .otherwise(cut)
    )


def sentences(text: Column) -> Column:
    """The sentences of a text, long ones in parts; put together they are the text.

    Null and empty texts have none.
    """
    text = F.coalesce(text, F.lit(""))
    whole = F.when(
        F.octet_length(text) == F.char_length(text),
        F.regexp_extract_all(text, F.lit(ASCII_SENTENCE), 0),
    ).otherwise(F.regexp_extract_all(text, F.lit(SENTENCE_SCAN), 0))
    return F.flatten(F.transform(whole, _cut))


def sentence_key(sentence: Column) -> Column:
    """White space in single blanks, none at the ends; the case is the caller's."""
    def single(plain: Column) -> Column:
        odd = reduce(or_, [plain.contains(s) for s in ("  ", "\n", "\t", "\r")])
        return F.when(odd, F.regexp_replace(plain, r"[ \t\r\n]{2,}|[\t\r\n]", " ")).otherwise(plain)

    return _let(F.btrim(sentence, F.lit(" \t\r\n")), single)


def _spans(text: Column, size: int) -> Column:
    """Digest, place and repeat flag of each run of ``size`` sentences, or of the fewer there are.

    Each comes with the number of all sentences.
    """
    keys = F.transform(
        sentences(lower_ascii(text)),
        lambda s: _let(
            sentence_key(s),
            lambda key: F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(7), key).alias("b")),
        ),
    )

    def of_keys(k: Column) -> Column:
        def span(i: Column) -> Column:
            own = [F.get(k, i + j) for j in range(size)]
            return F.struct(
                F.xxhash64(*[o["a"] for o in own]).alias("a"),
                F.hash(*[o["b"] for o in own]).alias("b"), i.alias("at"),
            )

        places = F.sequence(F.lit(0), F.greatest(F.size(k) - size, F.lit(0)))
        found = F.sort_array(F.when(F.size(k) > 0, F.transform(places, span)))
        return F.struct(found.alias("spans"), F.size(k).alias("n"))

    def flagged(found: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            before = F.get(found["spans"], i - 1)
            again = (i > 0) & (before["a"] == s["a"]) & (before["b"] == s["b"])
            return F.struct(s["a"], s["b"], s["at"], again.alias("again"), found["n"].alias("n"))

        return F.transform(found["spans"], one)

    return _let(_let(keys, of_keys), flagged)


def drop_repeated_spans(docs: DataFrame, size: int = SPAN) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_sentences, n_removed, kept`` of every row.

    A span is a run of ``size`` sentences, or of all if a text has fewer; sentences are alike but
    for the case of A-Z and white space, and those of more than twelve words count as several. Of
    each span found more than once the first by (id, place) stays; sentences that any other one
    covers are removed. Rows of one id are one document, so repeated rows leave each other alone;
    null ids come before all others. Null and empty texts have no sentences and no span.

    The least id of each span comes from a pre-combined aggregate and is joined back, so a span
    that a third of all documents share is never one group. The sentences' text is not shuffled
    with the spans; texts move once, to meet the places to be removed.
    """
    first_id = F.lit(-(1 << 63)).cast("bigint")
    spans = written(
        docs.select(
            F.coalesce(F.col("doc_id").cast("bigint"), first_id).alias("_id"),
            F.xxhash64("text").alias("_text"),
            F.explode(_spans(F.col("text"), size)).alias("s"),
        ).select("_id", "_text", "s.a", "s.b", "s.at", "s.again", "s.n"),
        "spans",
    )
    shared = (
        spans.filter("NOT again").groupBy("a", "b")
        .agg(F.min("_id").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
        .select("a", "b", "first")
    )
    # half of a digest shares a number with the place, which makes the rows to be shuffled shorter
    packed = F.shiftleft(F.col("b").cast("bigint"), 32).bitwiseOR(F.col("at").cast("bigint"))
    firsts = spans.filter("NOT again").select("_id", "_text", "a", packed.alias("b_at"))
    b, at = F.shiftright("b_at", 32).cast("int"), F.col("b_at").bitwiseAND((1 << 31) - 1).cast("int")
    later = (
        firsts.join(shared, (firsts["a"] == shared["a"]) & (b == shared["b"]))
        .filter("_id > first").withColumn("at", at)
    )
    of = [F.col("_id").alias("_of"), F.col("_text").alias("_key")]
    nothing = F.lit(None).cast("int")
    own = spans.filter("again OR at = 0").select(  # each row with a span has one at 0, its first
        *of, F.when(F.col("again"), F.col("at")).alias("at"), F.when(F.col("at") == 0, F.col("n")).alias("n"),
    )
    places = own.unionByName(later.select(*of, "at", nothing.alias("n")))
    found = places.groupBy("_of", "_key").agg(
        F.sort_array(F.collect_set("at")).alias("_places"), F.max("n").alias("_n")
    )
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), first_id).alias("_id"),
        F.xxhash64("text").alias("_text"),
    )
    joined = rows.join(
        found, (F.col("_id") == F.col("_of")) & (F.col("_text") == F.col("_key")), "left"
    )
    text, places = F.coalesce("row.text", F.lit("")), F.col("_places")
    changed = joined.withColumn(
        "_sentences", F.when(F.size(places) > 0, sentences(F.col("row.text")))
    )
    # what is between two removed spans: from the end of one to the start of the next
    starts = F.concat(F.array(F.lit(0)), F.transform(places, lambda p: p + size))
    ends = F.concat(places, F.array(F.size("_sentences")))
    stretches = F.zip_with(
        starts, ends,
        lambda a, b: F.slice(F.col("_sentences"), a + 1, F.greatest(b - a, F.lit(0))),
    )
    kept = changed.withColumn(
        "_kept", F.when(F.col("_sentences").isNotNull(), F.flatten(stretches))
    )
    n_removed = F.coalesce(F.size("_sentences") - F.size("_kept"), F.lit(0))
    return kept.select(
        "row",
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_sentences"),
        F.when(F.col("_kept").isNull(), 0).otherwise(n_removed).cast("bigint").alias("n_removed"),
        F.when(F.col("_kept").isNull(), text).otherwise(F.array_join("_kept", "")).alias("kept"),
    )
