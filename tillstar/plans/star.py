"""The star schema as a set of frames, and how it is built from clean lines."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.operators import dimensions as dim
from tillstar.operators.facts import fact_order_items, require_no_orphans
from tillstar.operators.ordered import ONE_TASK_ROWS
from tillstar.operators.quarantine import good_counts, good_lines, judge_lines, summary_of
from tillstar.operators.quarantine import rejected_rows as quarantined
from tillstar.schemas import LOAD_ORDER
from tillstar.session import shared_dir
from tillstar.sources.raw import read_raw_csv
from tillstar.sources.tables import RETAIL_SUFFIX, counter_lines, retail_lines
from tillstar.sources.warehouse import read_published, read_table, staged

Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_time: DataFrame
    dim_item: DataFrame
    dim_ingredient: DataFrame
    bridge_item_ingredient: DataFrame
    fact_order_items: DataFrame
    #: Number of rows of ``dim_item``: an upper bound for every per-product result.
    item_rows: int
    #: Raw rows with the reason why they are not in the fact, if the star comes from raw rows.
    rejected_rows: DataFrame | None = None
    #: All raw rows, typed, with ``reject_reason``: what run summaries are made from.
    judged: DataFrame | None = None
    #: Their run summary.
    summary: DataFrame | None = None

    def items(self, *columns: str) -> DataFrame:
        """Columns of the item dimension for a join with lines.

        The written size tells Spark whether to broadcast them. Otherwise it shuffles both sides by
        key and splits keys that are too frequent.
        """
        return self.dim_item.select(*columns)

    def tables(self) -> dict[str, DataFrame]:
        own = {f.name: getattr(self, f.name) for f in fields(self) if f.name in LOAD_ORDER}
        return {name: df for name, df in own.items() if df is not None}


def build_star(
    lines: DataFrame,
    stage: Stage,
    noun: str = "item",
    size_suffix: str = dim.SIZE_SUFFIX,
    one_task_rows: int = ONE_TASK_ROWS,
) -> Star:
    """Dimensions and fact from clean lines.

    Each table is written once and read back, so nothing upstream runs twice, and the joins that
    follow know the written sizes: small dimensions broadcast, large ones shuffle and may split.
    """
    lines = stage(lines, "lines")
    attributes = stage(dim.item_attributes(lines, noun, size_suffix), "item_attributes")
    item_rows = attributes.count()
    items = stage(dim.item_dimension(attributes, item_rows, one_task_rows), "dim_item")
    parts = stage(dim.recipe_parts(items), "recipe_parts")
    names = parts.select("ingredient_name").distinct().count()
    ingredients = stage(dim.ingredient_dimension(parts, names, one_task_rows), "dim_ingredient")
    fact = stage(fact_order_items(lines, items), "fact_order_items")
    require_no_orphans(fact)
    return Star(
        dim_date=stage(dim.date_dimension(lines), "dim_date"),
        dim_time=stage(dim.time_dimension(lines.sparkSession).coalesce(1), "dim_time"),
        dim_item=items,
        dim_ingredient=ingredients,
        bridge_item_ingredient=stage(
            dim.ingredient_bridge(parts, ingredients), "bridge_item_ingredient"
        ),
        fact_order_items=fact,
        item_rows=item_rows,
    )


def star_from_csv(spark: SparkSession, path: str, folder: str, noun: str = "item") -> Star:
    """Judge the lines of raw CSV files and build the star of the good ones under ``folder``.

    Every raw row is either a line of the fact or a row of ``rejected_rows``, with its reason. Both are
    counted for the run summary while they are written.
    """
    def stage(df: DataFrame, name: str) -> DataFrame:
        return staged(df, folder, name)

    good, bad = Observation(), Observation()
    judged = judge_lines(read_raw_csv(spark, path, noun), noun=noun, stage=stage, unique=True)
    star = build_star(good_lines(judged).observe(good, *good_counts()), stage, noun)
    rejected = stage(quarantined(judged).observe(bad, F.count(F.lit(1)).alias("rejected_rows")), "rejected_rows")
    summary = stage(summary_of(spark, good.get, bad.get), "run_summary")
    return replace(star, rejected_rows=rejected, judged=judged, summary=summary)


def star_from_published(spark: SparkSession, root: str, noun: str = "item") -> Star:
    tables = read_published(spark, root, noun)
    return Star(**tables, item_rows=tables["dim_item"].count())


_SOURCES = {
    "retail": (retail_lines, RETAIL_SUFFIX),
    "counter": (counter_lines, dim.SIZE_SUFFIX),
}
_BUILT: dict[tuple[str, str, str], tuple[str, Star]] = {}


def star_of(spark: SparkSession, sf_dir: str, source: str = "retail") -> Star:
    """The star of a set of test tables, built once per application in the shared folder."""
    key = (spark.sparkContext.applicationId, str(sf_dir), source)
    if key not in _BUILT or not _still_there(spark, _BUILT[key][0]):
        lines, suffix = _SOURCES[source]
        folder = f"{shared_dir(spark)}/star-{source}-{uuid.uuid4().hex[:8]}"
        star = build_star(
            lines(spark, sf_dir), lambda df, name: staged(df, folder, name), size_suffix=suffix
        )
        _BUILT[key] = folder, star
    return _BUILT[key][1]


def _still_there(spark: SparkSession, folder: str) -> bool:
    try:
        read_table(spark, folder, "fact_order_items")
        return True
    except FileNotFoundError:
        return False


def enriched(star: Star) -> DataFrame:
    """Lines with all their dimension attributes.

    Items, which may be too many to broadcast, are joined first, so that no text of a day or an hour
    is shuffled along.
    """
    return (
        star.fact_order_items.join(star.dim_item.drop("unit_price"), "item_key")
        .join(star.dim_date, "date_key")
        .join(star.dim_time, "time_key")
    )


def register_views(star: Star, noun: str = "item") -> None:
    from tillstar.plans.views import VIEWS
    from tillstar.schemas import from_item_names, table_name

    for name, df in star.tables().items():
        from_item_names(df, noun).createOrReplaceTempView(table_name(name, noun))
    for name, view in VIEWS.items():
        from_item_names(view(star), noun).createOrReplaceTempView(name)


def view(spark: SparkSession, name: str, order_by: str | None = None) -> DataFrame:
    """A registered view, sorted if asked."""
    out = spark.table(name)
    return out.orderBy(*[c.strip() for c in order_by.split(",")]) if order_by else out
