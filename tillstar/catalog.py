"""Every query by name: ``query(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.money import money
from tillstar.functions.text import title_case, with_clean_text
from tillstar.operators import dimensions, history, profiling, quality, quarantine
from tillstar.operators.affinity import basket_affinity
from tillstar.operators.groups import keep_first
from tillstar.plans import analyst, cube, insights, measures, views
from tillstar.plans.measures import SliceSpec
from tillstar.plans.star import Star, register_views, star_from_csv, star_of, view
from tillstar.schemas import DAY_PARTS, RAW_COLUMNS
from tillstar.sources import tables as src
from tillstar.sources import warehouse
from tillstar.sources.raw import read_raw_csv
from tillstar.streaming import hourly, incremental
from tillstar.streaming import quarantine as stream_rules
from tillstar.streaming.sources import Inbox, new_folder, one_batch_each

Query = Callable[[SparkSession, str], DataFrame]

RETAIL_CATEGORIES = ("Economy", "Medium", "Promo", "Small", "Standard")


def _on(source: str, plan: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(star_of(spark, sf_dir, source))


def _retail(plan: Callable[[Star], DataFrame]) -> Query:
    return _on("retail", plan)


def _counter(plan: Callable[[Star], DataFrame]) -> Query:
    return _on("counter", plan)


def _raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(src.retail_text(spark, sf_dir).drop("_row"))


def _judged(plan: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "quarantine")
        return plan(
            quarantine.judge_lines(
                src.retail_text(spark, sf_dir),
                stage=lambda df, name: warehouse.staged(df, folder, name),
            )
        )

    return query


# --- cleaning --------------------------------------------------------------------------------


def _clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "clean")
    return quarantine.clean_lines(
        src.retail_text(spark, sf_dir), stage=lambda df, name: warehouse.staged(df, folder, name)
    )


def _dedup_line_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = src.table(spark, sf_dir, "lineitem")
    return keep_first(lines, ["l_orderkey", "l_linenumber"], src.LINE_ORDER).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        money(F.col("l_extendedprice")).alias("amount"),
    )


def _dedup_line_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.retail_lines(spark, sf_dir).select(
        F.col("item_id").alias("order_item_id"), "order_id", "item_name_id", "quantity"
    )


def _text_hygiene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through the text rules; reported by what is left of them.

    Every seventh text starts with a ligature, full-width letters and digits and a wide blank.
    """
    planted = F.when(F.col("doc_id") % 7 == 3, "ﬁne ＡＢＣ　１２ ").otherwise("")
    documents = src.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(planted, "text").alias("clean"), "source"
    )
    documents = with_clean_text(documents, ["clean", "source"])
    return documents.select(
        "doc_id",
        F.length("clean").cast("bigint").alias("clean_chars"),
        F.md5("clean").alias("clean_md5"),
        title_case(F.col("source")).alias("source_title"),
    )


def _day_part_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day parts found by joining a range table instead of a CASE; five rows, so broadcast."""
    star = star_of(spark, sf_dir, "counter")
    ranges = spark.createDataFrame(DAY_PARTS, "lo int, hi int, part string")
    hours = star.fact_order_items.groupBy(F.col("time_key").alias("hour")).agg(
        F.count("*").alias("lines")
    )
    return (
        hours.join(F.broadcast(ranges), F.col("hour").between(F.col("lo"), F.col("hi")))
        .groupBy(F.col("part").alias("day_part"))
        .agg(F.sum("lines").alias("lines"))
    )


# --- raw files -------------------------------------------------------------------------------


def _csv_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw text lines as CSV files in the shared folder, in the order of their copies.

    Copies are told by file name and place in the file. Lines are dealt in ranges of that order, so
    every task writes its share; part files are numbered as the ranges are. Text is made of the lines
    after they are dealt, and the files are compressed.
    """
    folder = new_folder(spark, "raw-csv")
    order = [*src.LINE_ORDER, "place"]
    dated = src.dated_lines(spark, sf_dir)
    ranges = dated.repartitionByRange(*order).sortWithinPartitions(*order)
    src.as_text(ranges).select(*RAW_COLUMNS).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        compression="gzip", **{"zlib.compress.level": "BEST_SPEED"},
    ).csv(folder)
    return folder


def _raw_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_csv(spark, _csv_files(spark, sf_dir)).select(*RAW_COLUMNS)


def _pipeline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to published star: row counts of the seven tables and of the source, and the gate's say."""
    root = new_folder(spark, "warehouse")
    star = star_from_csv(spark, _csv_files(spark, sf_dir), f"{root}-work")
    warehouse.publish(star.tables(), root)
    loaded = warehouse.read_published(spark, root)
    report = quality.quality_report(loaded, categories=RETAIL_CATEGORIES)
    rate = report.filter(F.col("check").startswith("rejection rate"))
    return (
        warehouse.counts(loaded).withColumn("status", F.lit("loaded"))
        .unionByName(star.summary.select(F.lit("source").alias("table"),
                                    F.col("source_rows").alias("rows"), F.lit("read").alias("status")))
        .unionByName(rate.select(F.lit("rejection rate").alias("table"),
                                 F.col("bad_count").alias("rows"), "status"))
    )


def _large_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the measures where amounts are huge next to what sets them apart.

    By line: every amount 16501701907.01, or a billion with and without half a unit.
    """
    raw = src.retail_text(spark, sf_dir).drop("_row")
    key = F.col("order_id").cast("bigint") % 2
    return profiling.numeric(raw.withColumns({
        "unit_price": F.lit("16501701907.01"),
        "total_price": F.when(key == 0, "1000000000.00").otherwise("1000000000.50"),
    }))


# --- star schema -----------------------------------------------------------------------------


def _order_context(star: Star) -> DataFrame:
    return star.fact_order_items.select(
        "order_item_id", "order_id", "order_line_count", "order_item_count", "order_total_value"
    )


TRACKED = ["unit_price", "item_category", "item_size", "item_ingredients"]


def _scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the rows of the product dimension: its price, category, size and recipe by day."""
    lines = src.retail_lines(spark, sf_dir).withColumn("day", F.col("order_ts").cast("date"))
    return history.versions(lines, "item_name_id", "day", TRACKED, "item_id")


def _scd2_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same versions, kept up to date year by year instead of rebuilt."""
    lines = src.retail_lines(spark, sf_dir).withColumn("day", F.col("order_ts").cast("date"))
    lines = lines.select("item_name_id", "day", "item_id", *TRACKED, F.year("day").alias("year"))
    folder = new_folder(spark, "scd2-lines")
    lines.write.partitionBy("year").option("compression", "zstd").parquet(folder)
    lines = spark.read.schema(lines.schema).parquet(folder)  # a year reads its own files
    table = history.VersionTable(spark, new_folder(spark, "scd2"), "item_name_id", TRACKED)
    for r in lines.select("year").distinct().orderBy("year").collect():
        table.apply(lines.filter(F.col("year") == r.year), "day", "item_id")
    return table.read()


def _write_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish, read the published version back, export the extracts, report the row counts."""
    star = star_of(spark, sf_dir, "retail")
    root = new_folder(spark, "warehouse")
    warehouse.publish(star.tables(), root)
    exported = {name: views.VIEWS[name](star) for name in views.EXPORTED}
    warehouse.export_csv(exported, f"{root}/extracts")
    return warehouse.counts(warehouse.read_published(spark, root))


def _load_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = star_of(spark, sf_dir, "retail")
    root = new_folder(spark, "warehouse")
    warehouse.publish(star.tables(), root)
    loaded = warehouse.read_published(spark, root)
    revenue = views.total_of(loaded["fact_order_items"], "total_price")
    return warehouse.load_verification(loaded, star.tables()).withColumn(
        "total_revenue", money(revenue)
    )


def _loaded_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over the published tables as read back, so that more than the row counts must agree."""
    star = star_of(spark, sf_dir, "retail")
    root = new_folder(spark, "warehouse")
    warehouse.publish(star.tables(), root)
    loaded = warehouse.read_published(spark, root)
    sums = {
        "dim_date": "sum(date_key)", "dim_time": "sum(time_key * hour_24)",
        "dim_item": "sum(item_key * ingredient_count)",
        "dim_ingredient": "sum(ingredient_key * length(ingredient_name))",
        "bridge_item_ingredient": "sum(item_key * 1000 + ingredient_key)",
        "fact_order_items": "sum(order_item_id + item_key * quantity)",
    }
    parts = [
        loaded[name].select(F.expr(e).cast("bigint").alias("content"))
        .select(F.lit(name).alias("table"), "content") for name, e in sums.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _view_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view as a BI tool gets it: by its registered name, sorted."""
    register_views(star_of(spark, sf_dir, "retail"))
    return view(spark, "vw_monthly_trend", "year_month")


def _tables_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of the star as a BI tool imports them: by their registered names."""
    register_views(star_of(spark, sf_dir, "retail"))
    names = ["dim_date", "dim_time", "dim_item", "dim_ingredient", "bridge_item_ingredient", "fact_order_items"]
    return warehouse.counts({name: spark.table(name) for name in names})


def _extract_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract of a view, read back from its CSV files."""
    trend = views.VIEWS["vw_monthly_trend"](star_of(spark, sf_dir, "retail"))
    folder = new_folder(spark, "extracts")
    warehouse.export_csv({"vw_monthly_trend": trend}, folder)
    reader = spark.read.schema(trend.schema).option("header", True)
    return reader.csv(f"{folder}/vw_monthly_trend")


def _supplier_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that the same suppliers deliver: baskets of several hundred codes each."""
    lines = src.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    baskets = lines.select("l_suppkey").distinct().agg(F.count("*").alias("n"))
    parts = src.table(spark, sf_dir, "part").count()
    pairs = basket_affinity(lines, "l_suppkey", "l_partkey", baskets.scalar(), parts, 12)
    return pairs.withColumnsRenamed(
        {"a": "part_a", "b": "part_b", "orders_together": "suppliers_together"}
    )


def _recipe_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meat and cheese flags, with meat in every fifth recipe and cheese in every seventh.

    Each step is written once, as in the star build, so the lines are joined and deduplicated once.
    """
    part = F.regexp_extract("item_name_id", r"_(\d+)_", 1).cast("int")
    lines = src.retail_lines(spark, sf_dir).withColumn("item_ingredients", F.concat(
        "item_ingredients",
        F.when(part % 5 == 0, ", hAM").otherwise(""),
        F.when(part % 7 == 0, ",CHEESE ").otherwise(""),
    ))
    folder = new_folder(spark, "recipe-flags")

    def stage(df: DataFrame, name: str) -> DataFrame:
        return warehouse.staged(df, folder, name)

    lines = stage(lines.select(
        "item_id", "item_name_id", "item_name", "item_category", "item_size", "item_ingredients",
        "unit_price",
    ), "lines")
    attributes = stage(
        dimensions.item_attributes(lines, size_suffix=src.RETAIL_SUFFIX), "item_attributes"
    )
    items = stage(dimensions.item_dimension(attributes), "dim_item")
    parts = stage(dimensions.recipe_parts(items), "recipe_parts")
    names = dimensions.ingredient_dimension(parts)
    return items.select(
        F.col("item_name_id").alias("name"), "ingredient_count",
        F.col("is_vegetarian").alias("flag"),
    ).unionByName(names.select(
        F.col("ingredient_name").alias("name"), F.lit(1).alias("ingredient_count"),
        F.col("is_cheese").alias("flag"),
    ))


# --- quality ---------------------------------------------------------------------------------


def _report(star: Star) -> DataFrame:
    # These lines come from tables, not from raw text: none was rejected.
    return quality.quality_report(star.tables(), rejected_rows=0, categories=RETAIL_CATEGORIES)


# --- streams ---------------------------------------------------------------------------------


def _mixed_events(spark: SparkSession, sf_dir: str) -> Inbox:
    """``events`` as a stream of six micro-batches that each span the whole time."""
    events = src.table(spark, sf_dir, "events")
    part = F.col("event_id") % 6
    return one_batch_each([events.filter(part == i) for i in range(6)], new_folder(spark, "events"))


def _day_lines(events: DataFrame) -> DataFrame:
    return src.event_lines(events).select(
        "item_id", "order_id", "order_ts", "quantity", "unit_price", "total_price",
        F.col("order_ts").cast("date").alias("day"),
    )


def _stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_folder(spark, "incremental")
    incremental.incremental_load(
        _mixed_events(spark, sf_dir), _day_lines, target, f"{target}-state", ["item_id"], "day"
    )
    return incremental.loaded_lines(spark, target).groupBy("day").agg(
        F.count("*").alias("lines"), money(F.sum("total_price")).alias("revenue")
    )


def _hourly_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    target = new_folder(spark, "hourly")
    hourly.run_hourly(_mixed_events(spark, sf_dir), src.event_lines, target, f"{target}-state")
    return target, f"{target}-state"


def _stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_result(spark, *_hourly_stream(spark, sf_dir))


def _stream_hourly_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that left with their hour, that came late for it, and that are of hours still open."""
    target, checkpoint = _hourly_stream(spark, sf_dir)
    still_open = hourly.open_hours(spark, checkpoint).agg(F.sum("lines").alias("lines"))
    return hourly.arrivals(spark, target).unionByName(
        still_open.select(F.lit("open").alias("kind"), "lines")
    )


def _stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines in four micro-batches, by part: in each, times, orders and copies are mixed.

    The joined lines are written once, as the tables have them, so that the cuts and the four parts do
    not join the tables again. Text is made of a part as it is delivered.
    """
    target = new_folder(spark, "stream-quarantine")
    lines = warehouse.staged(src.dated_lines(spark, sf_dir), f"{target}-dated", "lines")
    cuts = lines.agg(F.expr("percentile_approx(l_partkey, array(0.25, 0.5, 0.75))")).first()[0]
    bounds = list(zip([None, *cuts], [*cuts, None]))
    part = F.col("l_partkey")
    parts = [
        src.as_text(lines.filter((part > lo if lo is not None else F.lit(True))
                                 & (part <= hi if hi is not None else F.lit(True))))
        for lo, hi in bounds
    ]
    inbox = one_batch_each(parts, f"{target}-raw", files=None)
    warehouse.discard(spark, f"{target}-dated")
    stream_rules.run_quarantine(inbox, target, f"{target}-state")
    rejected, accepted = stream_rules.outcome(spark, target)
    both = rejected.select(F.col("reject_reason").alias("outcome")).unionByName(
        accepted.select(F.lit("accepted").alias("outcome"))
    )
    return both.groupBy("outcome").agg(F.count("*").alias("rows"))


SLICE = SliceSpec(
    date_from="1996-01-01", date_to="1999-12-31", categories=("Economy", "Promo"),
    sizes=("M", "L"),
)


def _cube(source: str, where: SliceSpec, *by: str) -> Query:
    return lambda spark, sf_dir: cube.sliced(cube.cube_of(spark, sf_dir, source), where, by=by)


QUERIES: dict[str, Query] = {
    # cleaning
    "raw_scan": _raw(lambda raw: raw.select(*RAW_COLUMNS)),
    "raw_csv_scan": _raw_csv_scan,
    "pipeline_tables": _pipeline_tables,
    "quarantine_rows": _judged(quarantine.rejected_rows),
    "clean_rows": _clean_rows,
    "reject_summary": _judged(quarantine.reject_summary),
    "run_summary": _judged(quarantine.run_summary),
    "dedup_line_key": _dedup_line_key,
    "dedup_line_content": _dedup_line_content,
    "text_hygiene": _text_hygiene,
    "day_part_range_join": _day_part_range_join,
    # star schema
    "dim_date": _retail(lambda s: s.dim_date),
    "dim_time": _retail(lambda s: s.dim_time),
    "dim_product": _retail(lambda s: s.dim_item),
    "dim_ingredient": _retail(lambda s: s.dim_ingredient),
    "ingredient_bridge": _retail(lambda s: s.bridge_item_ingredient),
    "fact_order_items": _retail(lambda s: s.fact_order_items),
    "order_context": _retail(_order_context),
    "scd2_product": _scd2,
    "scd2_updated": _scd2_updated,
    "recipe_flags": _recipe_flags,
    "write_star": _write_star,
    "loaded_content": _loaded_content,
    "view_by_name": _view_by_name,
    "tables_by_name": _tables_by_name,
    "extract_read_back": _extract_read_back,
    "load_verification": _load_verification,
    # views
    "fact_enriched": _retail(views.fact_enriched),
    "kpi_headline": _retail(views.kpi_headline),
    "daily_sales": _retail(views.daily_sales),
    "monthly_trend": _retail(views.monthly_trend),
    "sales_by_category": _retail(views.sales_by_category),
    "sales_by_size": _retail(views.sales_by_size),
    "hourly_demand": _counter(views.hourly_demand),
    "weekday_hour_heatmap": _counter(views.weekday_hour_heatmap),
    "product_performance": _retail(views.product_performance),
    "basket_profile": _retail(views.basket_profile),
    "product_affinity": _retail(views.product_affinity),
    "supplier_affinity": _supplier_affinity,
    "ingredient_exposure": _retail(views.ingredient_exposure),
    # analyst questions
    "q01_headline": _counter(analyst.headline),
    "q02_monthly": _retail(analyst.monthly),
    "q03_weekday_pattern": _retail(analyst.weekday_pattern),
    "q04_day_part": _counter(analyst.day_part_share),
    "q05_pareto": _retail(analyst.pareto_list),
    "q06_delist": _retail(analyst.delist_candidates),
    "q07_levers": _retail(analyst.levers),
    "q08_cross_sell": _retail(analyst.cross_sell),
    "q08_affinity_matrix": _retail(lambda s: analyst.affinity_matrix(s, "0.95")),
    "q09_basket": _retail(analyst.basket_distribution),
    "q10_ingredients": _retail(analyst.top_ingredients),
    "q11_best_worst_days": _retail(analyst.best_and_worst_days),
    "q12_zero_sales_days": _retail(analyst.days_without_sales),
    "q13_reconciliation": _retail(analyst.price_rule_breaks),
    # quality gate
    "dq_report": _retail(_report),
    "dq_summary": _retail(lambda s: quality.quality_summary(_report(s))),
    "dq_constraints": _retail(lambda s: quality.constraint_report(s.tables())),
    "dq_unexpected_categories": _retail(
        lambda s: quality.unexpected_categories(s.dim_item, RETAIL_CATEGORIES)
    ),
    "dq_rejection_rate": _judged(quality.rejection_rate),
    # profile
    "profile_volume": _raw(profiling.volume),
    "profile_completeness": _raw(profiling.completeness),
    "profile_duplicates": _raw(profiling.duplicates),
    "profile_domains": _raw(profiling.domains),
    "profile_numeric": _raw(profiling.numeric),
    "profile_large_amounts": _large_amounts,
    "profile_dates": _raw(profiling.dates),
    "profile_rules": _raw(profiling.rules),
    "profile_fd": _raw(profiling.functional_dependencies),
    "profile_redundancy": _raw(profiling.redundancy),
    # insight numbers
    "insight_metrics": _retail(insights.year_metrics),
    "insight_hours": _counter(insights.busiest_hours),
    "peak_hours_flag": _counter(insights.hours_against_average),
    "insight_weekday_gap": _retail(insights.weekday_gap),
    "insight_abc": _retail(insights.abc_summary),
    "insight_mix": _retail(insights.mix_summary),
    "insight_basket": _retail(insights.basket_summary),
    # BI measures
    "kpi_sliced": _cube("retail", SLICE, "item_category"),
    "kpi_sliced_days": _cube(
        "retail", SliceSpec(date_from="1995-02-10", date_to="1997-03-20", categories=("Economy",)),
        "item_size",
    ),
    "kpi_sliced_lines": _retail(lambda s: measures.sliced(s, SLICE, by=["item_category"])),
    "kpi_sliced_day_part": _cube(
        "counter", SliceSpec(months=("2024-01",), day_parts=("Lunch", "Dinner")), "day_part"
    ),
    "selected_metric": _retail(
        lambda s: measures.selected_metric(s, "Average Order Value", ["item_category"])
    ),
    "mom_calendar": _retail(measures.mom_calendar),
    "mom_abs_prev": _retail(measures.mom_against_last_row),
    "ytd_revenue": _retail(measures.ytd_revenue),
    "moving_avg_calendar": _retail(measures.moving_avg_calendar),
    "share_of_selected": _retail(
        lambda s: measures.share_of_selected(s, SliceSpec(sizes=("S", "XL")), "item_category")
    ),
    "pareto_dense": _retail(measures.pareto_dense),
    "pareto_band": _retail(measures.pareto_bands),
    "pareto_local_variant": _retail(measures.pareto_of_rounded_shares),
    "abc_right_closed": _retail(
        lambda s: measures.pareto_of_rounded_shares(s).groupBy("abc_class").agg(
            F.count("*").alias("products")
        )
    ),
    "pareto_by_day_part": _counter(lambda s: measures.pareto_by_day_part(s, "Lunch")),
    "top_n_products": _retail(measures.top_n_products),
    "top15_products": _retail(lambda s: measures.first_products(s, 15)),
    "top5_products": _retail(lambda s: measures.first_products(s, 5)),
    "bottom10_products": _retail(lambda s: measures.first_products(s, 10, best=False)),
    "price_vs_volume": _retail(measures.price_vs_volume),
    "menu_quadrant": _retail(measures.menu_quadrant),
    "peak_window_share": _counter(measures.peak_window_share),
    "heatmap_pivot": _counter(measures.heatmap_pivot),
    "attach_rate": _retail(measures.attach_rate),
    "affinity_means": _retail(measures.affinity_means),
    "basket_lod": _retail(measures.basket_lod),
    "ingredient_concentration": _retail(measures.ingredient_concentration),
    "data_trust": _retail(measures.data_trust),
    "calendar_rollup": _retail(measures.calendar_rollup),
    "grouping_sets_mix": _retail(measures.grouping_sets_mix),
    # streams
    "stream_incremental": _stream_incremental,
    "stream_hourly": _stream_hourly,
    "stream_hourly_arrivals": _stream_hourly_arrivals,
    "stream_quarantine": _stream_quarantine,
}
