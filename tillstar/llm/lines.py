"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.tables import ASCII_SPACE, digest, lower_ascii, new_folder, written

BATCHES = 8
FAN_IN = 4


def text_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(ASCII_SPACE)))


class LineRuns:
    """Line hashes with the number of documents that hold them, as sorted runs in levels.

    A batch is reduced to one row per hash. Hashes that the runs already hold as frequent are
    taken out by a merge anti join; the rest becomes a run of level 0. ``fan_in`` runs of a level
    are merged into one run of the next, which sums their counts. All runs are written in the
    shared folder, so a lost executor costs its tasks only.
    """

    def __init__(self, folder: str, at_least: int, fan_in: int = FAN_IN):
        self.folder, self.at_least, self.fan_in = folder, at_least, fan_in
        self.levels: list[list[DataFrame]] = [[]]
        self.made = 0

    def _write(self, counts: DataFrame, level: int) -> DataFrame:
        path = f"{self.folder}/level{level}-run{self.made}"
        self.made += 1
        counts.sortWithinPartitions("a", "b").write.parquet(path)
        return counts.sparkSession.read.schema(counts.schema).parquet(path)

    def _all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for run in runs[1:]:
            both = both.unionByName(run)
        return both.groupBy("a", "b").agg(F.sum("docs").alias("docs"))

    def add(self, hashes: DataFrame) -> None:
        """Add a batch: one row ``a, b`` for each document and each of its distinct lines."""
        counts = hashes.groupBy("a", "b").agg(F.count("*").alias("docs"))
        for run in self._all():
            known = run.filter(F.col("docs") >= self.at_least).select("a", "b")
            counts = counts.join(known.hint("merge"), ["a", "b"], "left_anti")
        self.levels[0].append(self._write(counts, 0))
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            merged = self._write(self._merged(self.levels[level]), level + 1)
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)
            level += 1

    def frequent(self) -> DataFrame:
        """Hashes found in enough documents, each once."""
        runs = self._all()
        return self._merged(runs).filter(F.col("docs") >= self.at_least).select("a", "b")


def drop_frequent_lines(
    docs: DataFrame, at_least: int = 10, min_chars: int = 1, batches: int = BATCHES
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_lines, n_dropped, kept`` of every row of ``docs``.

    Lines whose key (stripped, A-Z lower-cased) has ``min_chars`` code points or more and is found
    in ``at_least`` documents are dropped everywhere. Each row is a document, so a repeated row
    counts again and a key counts once per row. Null text is one empty line; rows with a null id
    are documents too. An empty table gives an empty result. ``kept`` has the other lines.
    """
    spark = docs.sparkSession
    hashed = F.transform(
        text_lines(F.col("text")),
        lambda line: F.when(F.char_length(line_key(line)) >= min_chars, digest(line_key(line))),
    )
    keyed = docs.select(
        "doc_id", F.xxhash64("text").alias("_text"), hashed.alias("_hashes"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int").alias("_batch"),
    )
    keyed = written(keyed, "line-hashes", partition_by="_batch")
    runs = LineRuns(new_folder(spark, "line-runs"), at_least)
    for batch in range(batches):
        own = keyed.filter(F.col("_batch") == batch)
        runs.add(
            own.select(F.explode(F.array_distinct("_hashes")).alias("h"))
            .filter("h IS NOT NULL").select("h.a", "h.b")
        )
    frequent = written(runs.frequent(), "frequent-lines")
    places = keyed.select("doc_id", "_text", F.posexplode("_hashes").alias("_at", "h"))
    dropped = (
        places.filter("h IS NOT NULL").select("doc_id", "_text", "_at", "h.a", "h.b")
        .join(frequent, ["a", "b"])
        .groupBy("doc_id", "_text")
        .agg(F.sort_array(F.collect_set("_at")).alias("_drop"))
        .withColumnRenamed("doc_id", "_id").withColumnRenamed("_text", "_key")
    )
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64("text").alias("_text")
    )
    joined = rows.join(
        dropped,
        F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key")), "left",
    )
    lines, drop = F.col("_lines"), F.coalesce("_drop", F.array().cast("array<int>"))
    kept = joined.withColumn("_lines", text_lines(F.col("row.text"))).withColumn(
        # the stretches between dropped lines, so that cost stays linear in the lines
        "_cuts", F.concat(F.array(F.lit(-1)), drop, F.array(F.size(lines)))
    )
    cuts = F.col("_cuts")
    stretches = F.transform(
        F.sequence(F.lit(1), F.size(cuts) - 1),
        lambda i: F.slice(
            lines, F.element_at(cuts, i) + 2,
            F.element_at(cuts, i + 1) - F.element_at(cuts, i) - 1,
        ),
    )
    return kept.select(
        "row",
        F.size(lines).cast("bigint").alias("n_lines"),
        F.size(drop).cast("bigint").alias("n_dropped"),
        F.array_join(F.flatten(stretches), "\n").alias("kept"),
    )
