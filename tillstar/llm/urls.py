"""URL filters: explicit rules, then the ratio of two character language models."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.tables import digest, lower_ascii, written

ORDER = 4
FOLDS = 5
#: Grams with more than one in so many of all positions are looked up by broadcast: fewer than
#: that many grams can be so frequent, whatever the input.
HOT_SHARE = 10_000
#: Scores are compared in steps of a thousandth of a nat for each character, up to these bounds.
MOST_STEPS = 20_000

_START, _END = "\x02", "\x03"
_FLOOR = 1 / 256


class Rule(NamedTuple):
    """``verdict`` for a host with its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def with_address(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path`` and ``address`` (what the models read: the URL without its scheme).

    Null counts as empty; without ``://`` host and path are empty and the address is the whole text.
    """
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substr(rest, F.char_length(host) + 1)
    return pages.withColumns({
        "host": lower_ascii(host),
        "path": F.regexp_extract(tail, "^[^?#]*", 0),
        "address": F.when(at > 0, F.concat(lower_ascii(host), tail)).otherwise(text),
    })


def longest_rule(rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits ``host`` and ``path``; null if none does."""
    host, path = F.col("host"), F.col("path")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _grams(address: Column, order: int) -> Column:
    """For each character and the end: itself behind its ``order`` characters of context."""
    marks = F.array_repeat(F.lit(_START), order)
    letters = F.when(address == "", F.array().cast("array<string>")).otherwise(F.split(address, ""))
    padded = F.concat(marks, letters, F.array(F.lit(_END)))

    def each(chars: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(chars) - order),
            lambda i: F.array_join(F.slice(chars, i, order + 1), ""),
        )

    return F.element_at(F.transform(F.array(padded), each), 1)


def _fold(address: Column) -> Column:
    return F.conv(F.left(F.md5(address), F.lit(8)), 16, 10).cast("bigint") % FOLDS


_MODELS = ("allow_fit", "block_fit", "allow_all", "block_all")


def gram_counts(addresses: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n`` and how often each model has seen it, from distinct ``address, label, held``.

    The models are of allowed and of blocked addresses, each without the held-out ones and with
    them. Counts cover all addresses; equal grams add up on the map side.
    """
    seen = {
        "allow_fit": (F.col("label") == "allow") & ~F.col("held"),
        "block_fit": (F.col("label") == "block") & ~F.col("held"),
        "allow_all": F.col("label") == "allow",
        "block_all": F.col("label") == "block",
    }
    rows = addresses.select(
        *[F.coalesce(c, F.lit(False)).cast("int").alias(m) for m, c in seen.items()],
        F.explode(_grams(F.col("address"), order)).alias("gram"),
    )
    return rows.groupBy("gram").agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in _MODELS])


def gram_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n, fit, all``: log ratio of both models for each gram, in millionths of a nat.

    A model interpolates all context lengths (Witten and Bell): what a context has shown is
    weighed against its number of different followers times the estimate of the next shorter
    context; a context that was never seen leaves it to the shorter one. The chain ends at 1/256
    for any character. Each length needs its grams, their contexts and the grams one shorter; no
    key of these joins has more rows than there are different characters.
    """

    def by_suffix(k: int) -> DataFrame:
        return counts.groupBy(F.right("gram", F.lit(k + 1)).alias("gram")).agg(
            *[F.sum(m).alias(m) for m in _MODELS]
        )

    seen = [F.sum(m).alias(f"{m}_n") for m in _MODELS]
    totals = seen + [F.count_if(F.col(m) > 0).alias(f"{m}_kinds") for m in _MODELS]

    def estimate(m: str, shorter: Column) -> Column:
        n, kinds = F.col(f"{m}_n").cast("double"), F.col(f"{m}_kinds").cast("double")
        found = (F.col(m).cast("double") + kinds * shorter) / (n + kinds)
        return F.when(n > 0, found).otherwise(shorter)

    letters = written(by_suffix(0), "url-letters")
    whole = letters.agg(*totals).first()  # one row of eight numbers
    known = letters.withColumns({k: F.lit(whole[k] or 0) for k in whole.asDict()})
    level = known.select("gram", *[estimate(m, F.lit(_FLOOR)).alias(f"p_{m}") for m in _MODELS])
    for k in range(1, order + 1):
        grams = by_suffix(k) if k < order else counts
        keep = ["gram", *(["n"] if k == order else [])]
        context = F.left("gram", F.lit(k))
        contexts = grams.groupBy(context.alias("_context")).agg(*totals)
        shorter = level.withColumnRenamed("gram", "_shorter")
        joined = (
            grams.join(contexts, F.left(grams["gram"], F.lit(k)) == F.col("_context"))
            .join(shorter, F.right(grams["gram"], F.lit(k)) == F.col("_shorter"))
        )
        level = joined.select(
            *[grams[c] for c in keep],
            *[estimate(m, F.col(f"p_{m}")).alias(f"p_{m}") for m in _MODELS],
        )

    def ratio(kind: str) -> Column:
        nats = F.ln(f"p_allow_{kind}") - F.ln(f"p_block_{kind}")
        return F.round(nats * 1_000_000).cast("bigint").alias(kind)

    return level.select("gram", "n", ratio("fit"), ratio("all"))


def _scores(addresses: DataFrame, ratios: DataFrame, positions: int, order: int) -> DataFrame:
    """``a, b, label, score``: thousandths of a nat for each character, by digest of the address.

    An address with a label is judged by the models that have not seen it.
    """
    grams = addresses.select(
        "a", "b", "label", F.explode(_grams(F.col("address"), order)).alias("gram")
    )
    value = F.when(F.col("label").isNotNull(), F.col("fit")).otherwise(F.col("all"))
    hot = F.broadcast(ratios.filter(F.col("n") * HOT_SHARE > positions).drop("n"))
    cold = ratios.filter(F.col("n") * HOT_SHARE <= positions).drop("n")

    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy("a", "b", "label").agg(
            F.sum(value).alias("nats"), F.count("*").alias("chars")
        )

    both = sums(grams.join(hot, "gram")).unionByName(
        sums(grams.join(hot.select("gram"), "gram", "left_anti").join(cold, "gram"))
    )
    steps = F.floor(F.sum("nats") / (F.sum("chars") * 1000))
    bounded = F.greatest(F.lit(-MOST_STEPS), F.least(F.lit(MOST_STEPS), steps))
    return both.groupBy("a", "b", "label").agg(bounded.cast("bigint").alias("score"))


def calibrated_threshold(scores: DataFrame) -> int:
    """The least score to allow, from held-out ``label, score``; the one with the fewest errors.

    Errors are the share of allowed rows below it plus the share of blocked rows from it on; of
    equals the one nearest to 0, then the lower. Without held-out rows of both labels it is 0. The
    counts are for each score, of which there are 40,001 at most.
    """
    bins = scores.groupBy("score").agg(
        F.count_if(F.col("label") == "allow").alias("allow"),
        F.count_if(F.col("label") == "block").alias("block"),
    )
    rows = sorted((r.score, r.allow, r.block) for r in bins.collect())
    allowed, blocked = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not allowed or not blocked:
        return 0
    missed, caught, best = 0, 0, []
    for score, allow, block in rows:
        best.append((missed * blocked + (blocked - caught) * allowed, abs(score), score))
        missed, caught = missed + allow, caught + block
    return min(best)[2]


def judge_urls(
    pages: DataFrame, rules: list[Rule], url: str = "url", order: int = ORDER
) -> DataFrame:
    """``row`` (all columns of ``pages``), ``host, path, rule, verdict, score`` of every row.

    The longest rule that fits decides (of two alike the one with the longer host). What allow
    rules accept and block rules reject teaches two character models; other URLs are allowed if
    the log-likelihood of the first less that of the second, for each character, reaches a
    threshold. One address in five of those under rules is held out to choose it, with models that
    have not seen them; the models that judge have seen all. ``score`` is null under a rule.

    Null counts as the empty URL, which has an end and so a score. Each address teaches once,
    however often it is repeated, and repeated rows repeat. Without addresses under rules of both
    verdicts there is nothing to compare, and all others are allowed. Nothing is cut short.
    """
    rows = with_address(pages.select(
        F.struct(*[pages[c] for c in pages.columns]).alias("row"), pages[url].alias("_url")
    ), "_url")
    rule, verdict = longest_rule(rules)
    rows = rows.withColumns({"rule": rule, "_ruled": verdict})
    addresses = written(
        rows.select("address", F.col("_ruled").alias("label")).distinct().select(
            "address", "label", (_fold(F.col("address")) == 0).alias("held"),
            digest(F.col("address")).alias("d"),
        ).select("address", "label", "held", "d.a", "d.b"),
        "url-addresses",
    )
    under_rules = rows.filter("_ruled IS NOT NULL").select(
        "row", "host", "path", "rule", F.col("_ruled").alias("verdict"),
        F.lit(None).cast("bigint").alias("score"),
    )
    others = rows.filter("_ruled IS NULL")
    verdicts = {r.label for r in addresses.select("label").distinct().collect()}
    if not verdicts >= {"allow", "block"}:
        return under_rules.unionByName(others.select(
            "row", "host", "path", "rule", F.lit("allow").alias("verdict"),
            F.lit(None).cast("bigint").alias("score"),
        ))
    counts = written(gram_counts(addresses, order), "url-grams")
    ratios = written(gram_ratios(counts, order), "url-ratios")
    positions = counts.agg(F.sum("n")).first()[0]
    # an address may come with a scheme under a rule and without one under none
    judged = addresses.filter("label IS NULL OR held")
    scores = written(_scores(judged, ratios, positions, order), "url-scores")
    threshold = calibrated_threshold(scores.filter("label IS NOT NULL"))
    key = digest(F.col("address"))
    free = scores.filter("label IS NULL").select(
        F.col("a").alias("_a"), F.col("b").alias("_b"), "score"
    )
    keyed = others.withColumn("_k", key).select("row", "host", "path", "rule", "_k.a", "_k.b")
    by_method = keyed.join(
        free, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))
    ).select(
        "row", "host", "path", "rule",
        F.when(F.col("score") >= threshold, "allow").otherwise("block").alias("verdict"), "score",
    )
    return under_rules.unionByName(by_method)
