"""Writing, publishing, verifying and reading the star schema."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.money import sum_money
from tillstar.schemas import LOAD_ORDER, TABLES, from_item_names, table_name, to_item_names
from tillstar.session import brief_shuffles

MANIFEST = "run string, published_at timestamp, table string, rows bigint"


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table and go on from the written copy: short lineage, exact sizes for joins.

    Shuffle files that went into it are removed with the write.
    """
    path = f"{folder}/{name}"
    with brief_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a staged table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, folder: str, name: str, noun: str = "item") -> DataFrame:
    """A typed table; a missing one is named in the error."""
    path = f"{folder}/{table_name(name, noun)}"
    schema = TABLES.get(name)
    try:
        if schema is None:
            return to_item_names(spark.read.parquet(path), noun)
        published = from_item_names(spark.createDataFrame([], schema), noun).schema
        return to_item_names(spark.read.schema(published).parquet(path), noun)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise FileNotFoundError(f"no table at {path}") from e
        raise


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of several tables in one job."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_verification(loaded: dict[str, DataFrame], source: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the loaded tables against their source."""
    left = counts(loaded).withColumnRenamed("rows", "loaded_rows")
    right = counts(source).withColumnRenamed("rows", "source_rows")
    status = F.when(F.col("loaded_rows") == F.col("source_rows"), "OK").otherwise("MISMATCH")
    return left.join(right, "table").withColumn("status", status)


def publish(
    tables: dict[str, DataFrame],
    root: str,
    noun: str = "item",
    partition_by: dict[str, list[str]] | None = None,
    file_format: str = "parquet",
) -> str:
    """Full refresh, all or nothing; returns the run name.

    Tables go to a folder of their own, parents first. Row counts and revenue, taken of the source
    as it is written, are compared with what can be read back, and only then is one manifest file
    added. Readers take the newest manifest entry,
    so until that file appears they see the former run, whole. Nothing is overwritten, and a
    failed run leaves no trace for readers.
    """
    spark = next(iter(tables.values())).sparkSession
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/runs/{run}"
    order = [t for t in LOAD_ORDER if t in tables] + [t for t in tables if t not in LOAD_ORDER]
    seen: dict[str, Observation] = {}
    for name in order:
        columns = (partition_by or {}).get(name, [])
        # Few files per partition folder, yet a folder with most of the rows still gets many tasks.
        df = tables[name].hint("rebalance", *columns) if columns else tables[name]
        seen[name] = Observation(f"{run}-{name}")
        df = df.observe(seen[name], *_observed(name))
        with brief_shuffles(spark):
            writer = from_item_names(df, noun).write.mode("overwrite").format(file_format)
            if file_format == "parquet":
                writer = writer.option("compression", "zstd")
            if columns:
                writer = writer.partitionBy(*columns)
            writer.save(f"{folder}/{table_name(name, noun)}")
    loaded = {
        t: to_item_names(spark.read.format(file_format).load(f"{folder}/{table_name(t, noun)}"), noun)
        for t in order
    }
    report = [
        (r["table"], r["rows"], seen[r["table"]].get["rows"]) for r in counts(loaded).collect()
    ]
    bad = [t for t, rows, source_rows in report if rows != source_rows]
    if "fact_order_items" in tables and _revenue(loaded) != seen["fact_order_items"].get["revenue"]:
        bad.append("fact_order_items revenue")
    if bad:
        raise RuntimeError(f"load does not match its source, nothing published: {sorted(bad)}")
    rows = [(run, datetime.now(timezone.utc), t, rows) for t, rows, _ in report]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(
        f"{root}/manifest"
    )
    return run


def _observed(name: str) -> list[Column]:
    rows = [F.count(F.lit(1)).alias("rows")]
    if name == "fact_order_items":
        rows.append(sum_money(F.col("total_price")).alias("revenue"))
    return rows


def _revenue(tables: dict[str, DataFrame]):
    return tables["fact_order_items"].agg(sum_money(F.col("total_price"))).first()[0]


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise FileNotFoundError(f"nothing published under {root}") from e
        raise


def current_run(spark: SparkSession, root: str) -> str:
    newest = F.max_by("run", F.struct("published_at", "run"))
    return _manifest(spark, root).agg(newest).first()[0]


def read_published(spark: SparkSession, root: str, noun: str = "item") -> dict[str, DataFrame]:
    """The tables of the current run; ``rejected_rows`` is there if the run had raw rows."""
    run = current_run(spark, root)
    rows = _manifest(spark, root).filter(F.col("run") == run).select("table").collect()
    names = {r["table"] for r in rows}
    return {
        name: read_table(spark, f"{root}/runs/{run}", name, noun)
        for name in LOAD_ORDER if name in names
    }


def load_jdbc(
    tables: dict[str, DataFrame],
    url: str,
    properties: dict[str, str],
    schema: str = "public",
    batch_size: int = 5000,
    noun: str = "item",
) -> None:
    """Load into a database over JDBC: children emptied first, parents filled first.

    Emptying keeps table definitions, views and grants. Each partition commits by itself, so the
    all-or-nothing guarantee of :func:`publish` does not hold here; run it on a published version.
    """
    order = [t for t in LOAD_ORDER if t in tables]

    def write(name: str, df: DataFrame, mode: str, **options: str) -> None:
        target = f"{schema}.{table_name(name, noun)}"
        from_item_names(df, noun).write.options(batchsize=str(batch_size), **options).jdbc(
            url, target, mode, properties
        )

    for name in reversed(order):
        write(name, tables[name].limit(0), "overwrite", truncate="true", cascadeTruncate="true")
    for name in order:
        write(name, tables[name], "append")


def export_csv(
    views: dict[str, DataFrame], folder: str, noun: str = "item", compression: str = "gzip"
) -> None:
    """Extracts for a BI tool, one CSV folder per view.

    The lines with all their attributes are some two hundred characters each, mostly repeated ones, so
    files are compressed; ``none`` writes plain text for a tool that cannot unpack them.
    """
    for name, df in views.items():
        with brief_shuffles(df.sparkSession):
            from_item_names(df, noun).write.mode("overwrite").options(
                header=True, compression=compression
            ).csv(f"{folder}/{name}")
