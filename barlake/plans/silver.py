"""Landed tables to cleaned, keyed ones: one lazy plan per target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import (
    clean_volume, coerce_numeric, datetime_to_date, fill_zero, filter_a_share, gate_passes,
    int_to_date, lots_to_shares, numeric, per_ten_to_per_share, project_silver, quality_gate,
    rename_keys, strip_exchange, text_to_timestamp, ymd_to_date,
)
from ..operators.aggregates import dedup_keep_last, merge_same_day_events
from ..operators.documents import doc_hash, doc_render_html, doc_render_sections
from ..operators.joins import enrich_dimension, event_price_join, merge_by_priority
from ..operators.keep import keep_first
from ..operators.windows import change_pct, pre_close, single_factor, surrogate_id
from ..schemas import ADJ_FACTOR, DAILY, FINANCE, FINANCE_MEASURES, MINUTE, PRICES

DAILY_KEYS = ["stock_code", "trade_date"]
MINUTE_KEYS = ["stock_code", "datetime"]


def primary_bars(df: DataFrame) -> DataFrame:
    """Bars of the primary feed: plain codes, day in the first ten characters."""
    typed = df.select(
        F.col("stock_code").cast("string").alias("stock_code"),
        datetime_to_date(F.col("datetime")).alias("trade_date"),
        *PRICES, "volume", "amount",
    )
    return coerce_numeric(typed, [*PRICES, "volume", "amount"])


def secondary_bars(df: DataFrame) -> DataFrame:
    """Bars of the secondary feed: prefixed codes, volume in lots, no amount."""
    typed = df.select(
        strip_exchange(F.col("stock_code")).alias("stock_code"),
        datetime_to_date(F.col("date")).alias("trade_date"),
        *PRICES, "volume",
    )
    return coerce_numeric(typed, [*PRICES, "volume"]).withColumns({
        "volume": lots_to_shares(F.col("volume")),
        "amount": F.lit(None).cast("double"),
    })


def daily_bars(
    primary: DataFrame,
    secondary: DataFrame | None = None,
    seed: DataFrame | None = None,
    observation: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(daily table, rejected bars) from one or two landed feeds.

    The source is decided before the gate: a bad primary bar is rejected, not replaced. A bar
    whose date is unreadable is rejected too, so none stands before a code's first day.
    Among copies of a key in one source a passing bar is preferred. Two shuffles: the
    merge on (code, date), combined map-side, and the previous-close window on the code,
    whose groups hold one row per trading day.
    """
    sources = [primary_bars(primary)]
    if secondary is not None:
        sources.append(secondary_bars(secondary))
    bad = ~gate_passes(F.col("close"), F.col("high"), F.col("low"))
    merged = merge_by_priority(
        sources, DAILY_KEYS, [bad, *PRICES, "volume", "amount"]
    ).withColumn("volume", clean_volume(F.col("volume")))
    kept, rejects = quality_gate(merged, observation=observation, date="trade_date")
    bars = pre_close(kept, "stock_code", "trade_date", seed=seed).withColumn(
        "change_pct", change_pct(F.col("close"), F.col("pre_close"))
    )
    return bars.select(*DAILY.fieldNames()), rejects


def last_close(daily: DataFrame, before: Column) -> DataFrame:
    """Each code's last stored close before a day: the seed of an incremental build."""
    return (
        daily.filter(F.col("trade_date") < before)
        .groupBy("stock_code")
        .agg(F.max_by("close", "trade_date").alias("seed_close"))
    )


def landed_codes(primary: DataFrame, secondary: DataFrame | None = None) -> DataFrame:
    """(stock_code) of landed daily bars, in plain form."""
    codes = primary.select(F.col("stock_code").cast("string").alias("stock_code"))
    if secondary is not None:
        codes = codes.union(secondary.select(strip_exchange(F.col("stock_code"))))
    return codes.distinct()


def minute_bars(
    raw: DataFrame, observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """(minute table, rejected bars); a bar whose time is unreadable is rejected too.

    Of several copies of a bar the first to arrive is kept, where arrival is recorded, as a
    stream over the same files keeps it; values settle the rest.
    """
    arrival = [c for c in ("ingested_at",) if c in raw.columns]
    typed = project_silver(raw, [*MINUTE.fieldNames(), *arrival])
    typed = coerce_numeric(typed, [*PRICES, "vol", "amount"]).withColumn(
        "datetime", text_to_timestamp(F.col("datetime"))
    )
    ok = gate_passes(F.col("close"), F.col("high"), F.col("low")) & F.col("datetime").isNotNull()
    seen = typed
    if observation is not None:
        seen = typed.observe(
            observation, F.count(F.lit(1)).alias("read"), F.count_if(~ok).alias("rejected")
        )
    kept = keep_first(seen.filter(ok), MINUTE_KEYS, [*arrival, *PRICES, "vol", "amount"])
    return kept.drop(*arrival), typed.filter(~ok).drop(*arrival)


def since_marks(raw: DataFrame, marks: DataFrame, lag: str) -> DataFrame:
    """Landed minute bars that can be newer than the marks (stock_code, mark, arrived).

    Rows are stamped when they land, so those stamped more than ``lag`` before the last
    build's newest row were looked at then. Without stamps the bound is the least mark, if no
    code is unmarked: the day of a bar is compared as text, which never leaves out a later one.
    Both bounds are values, so the scan skips files and row groups by them.
    """
    if "ingested_at" in raw.columns:
        arrived = marks.agg(F.max("arrived")).first()[0]
        if arrived is None:
            return raw
        bound = F.lit(arrived).cast(raw.schema["ingested_at"].dataType) - F.expr(f"INTERVAL {lag}")
        return raw.filter((F.col("ingested_at") >= bound) | F.col("ingested_at").isNull())
    unmarked = raw.select("stock_code").distinct().join(marks, "stock_code", "left_anti")
    least = marks.agg(F.min("mark")).first()[0]
    if least is None or not unmarked.isEmpty():
        return raw
    if raw.schema["datetime"].dataType.typeName() != "string":
        return raw.filter(F.col("datetime") >= F.lit(least).cast(raw.schema["datetime"].dataType))
    # a text that doesn't begin with a digit may still be read as a time
    return raw.filter((F.col("datetime") >= f"{least:%Y-%m-%d}") | (F.col("datetime") < "0") | (F.col("datetime") >= ":"))


def corporate_actions(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Ex-right events (category 1) of real days, per share, one per code and day.

    Where several fall on one day the rights price is the first by ``order`` (columns of
    the landed table), by default by arrival where that is recorded.
    """
    terms = ["fenhong", "songzhuangu", "peigu"]
    order = list(order) or [c for c in ("ingested_at",) if c in raw.columns]
    events = raw.filter(F.col("category") == 1).select(
        F.col("code").alias("stock_code"),
        ymd_to_date(F.col("year"), F.col("month"), F.col("day")).alias("trade_date"),
        *terms, F.col("peigujia").alias("peigu_price"), *order,
    )
    events = events.filter(F.col("trade_date").isNotNull())
    events = fill_zero(coerce_numeric(events, [*terms, "peigu_price"]), [*terms, "peigu_price"])
    events = per_ten_to_per_share(events, terms)
    return merge_same_day_events(
        events, DAILY_KEYS, terms, "peigu_price", [*order, "peigu_price"]
    )


def with_factor(events: DataFrame, daily: DataFrame) -> DataFrame:
    priced = event_price_join(events, daily, DAILY_KEYS, "pre_close")
    return priced.withColumn(
        "single_factor",
        single_factor(F.col("pre_close"), F.col("fenhong"), F.col("peigu_price"),
                      F.col("peigu"), F.col("songzhuangu")),
    ).select(*ADJ_FACTOR.fieldNames())


def adj_factors(raw: DataFrame, daily: DataFrame) -> DataFrame:
    """Ex-right events with their single factor."""
    return with_factor(corporate_actions(raw), daily)


def finance_rows(raw: DataFrame, order: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """Statements: the last landed row per (code, date), typed; undated rows are dropped."""
    columns = ["code", "updated_date", "ipo_date", *FINANCE_MEASURES]
    latest = dedup_keep_last(
        raw.select(*columns, *order), ["code", "updated_date"],
        [*order, "ipo_date", *FINANCE_MEASURES],  # values settle equal arrival times
    )
    typed = coerce_numeric(latest.select(*columns), FINANCE_MEASURES).withColumns({
        c: int_to_date(F.col(c)) for c in ("updated_date", "ipo_date")
    })
    named = rename_keys(typed, {"code": "stock_code", "updated_date": "report_date"})
    return named.filter(F.col("report_date").isNotNull()).select(*FINANCE.fieldNames())


def instruments(
    stocks: DataFrame, finance: DataFrame, order: Sequence[str] = ("updated_date", "ingested_at")
) -> DataFrame:
    """A-share instruments with their listing date, not yet numbered."""
    lists = stocks.select("code", "name", "market").transform(filter_a_share)
    lists = keep_first(lists, ["code"], ["market", "name"])
    dated = finance.withColumn("ipo_date", int_to_date(F.col("ipo_date")))
    return enrich_dimension(lists, dated, "code", ["ipo_date"], order).select(
        F.col("code").alias("stock_code"),
        F.col("name").alias("stock_name"),
        "market",
        "ipo_date",
        F.lit(None).cast("date").alias("delist_date"),
    )


def stock_map(stocks: DataFrame, finance: DataFrame, **options) -> DataFrame:
    """The instrument dimension, numbered 1..n in code order."""
    return surrogate_id(
        instruments(stocks, finance, **options), "stock_code", name="stock_code_id"
    )


def doc_pages(docs: DataFrame) -> DataFrame:
    """Documents (stock_code, trade_date, text) to HTML rows with both hashes."""
    sources = docs.withColumn("source_hash", F.substring(F.sha2("text", 256), 1, 16))
    pages = doc_render_html(sources, code="stock_code")
    return doc_hash(pages, "html").select(
        "stock_code", "trade_date", "html", "file_size", "file_hash", "source_hash"
    )


def changed_pages(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_pages`` with their sections, of which those in ``known`` aren't parsed again."""
    sources = docs.withColumn("source_hash", F.substring(F.sha2("text", 256), 1, 16))
    pages = doc_render_sections(sources, known, code="stock_code")
    return doc_hash(pages, "html").select(
        "stock_code", "trade_date", "html", "file_size", "file_hash", "source_hash", "sections"
    )


def page_sections(pages: DataFrame) -> DataFrame:
    """One row per section of rendered pages."""
    rows = pages.select("stock_code", "trade_date", F.posexplode("sections").alias("i", "s"))
    return rows.select("stock_code", "trade_date", (F.col("i") + 1).alias("section_no"), "s.name", "s.section_hash", "s.html")


__all__ = [
    "adj_factors", "changed_pages", "corporate_actions", "daily_bars", "doc_pages", "finance_rows",
    "instruments", "landed_codes", "last_close", "minute_bars", "page_sections", "numeric", "primary_bars",
    "secondary_bars", "since_marks", "stock_map", "with_factor",
]
