"""Full, incremental and repair builds of the silver tables.

Every build ends with a new version of its table, which readers see as a whole or not at
all. A full build's is complete. An incremental one's adds the rows the table lacks, and a
day that lands late also corrects the bar after it; a repair's replaces rows. For the
year-partitioned bar tables and the reports, which lie in hash buckets, such a version holds
only the years or buckets that changed and goes on using the others. The codes of a repair
are a table throughout.

Of minute bars, each code's last stored time and the time up to which landed rows were
looked at belong to the version (``marks``), so an incremental build reads neither the
stored table nor landed rows it has seen.
"""

from __future__ import annotations

import contextlib
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import code_in_list, code_to_prefixed_lookup, date_prefix_filter
from ..operators import quality
from ..operators.documents import doc_changed, doc_hash
from ..operators.joins import marks_of, merge_marks, new_keys_only, newer_than_marks
from ..operators.upsert import new_rows, replace_keys, upsert_update
from ..operators.windows import change_pct, factor_steps, last_before, surrogate_id, update_steps
from ..schemas import (
    ADJ_FACTOR, ADJ_STEP, BUILD_RESULT, DAILY, DOC, DOC_SECTION, FINANCE, MINUTE, STOCK_MAP,
)
from ..sources.files import TEXT_CODEC, landed_documents, read_documents
from ..sources.sinks import (
    current_version, drop_old_versions, drop_unused_parts, measured, new_version, path_exists,
    read_version, remove_path, stored_years, write_parts, write_version,
)
from . import silver

# Dependency order: factors need daily bars.
TARGETS = ["stock_map", "daily", "adj_factor", "minute", "finance", "doc"]

_SCHEMAS = {
    "stock_map": STOCK_MAP, "daily": DAILY, "adj_factor": ADJ_FACTOR,
    "minute": MINUTE, "finance": FINANCE, "doc": DOC,
}
_KEYS = {
    "stock_map": ["stock_code"],
    "daily": ["stock_code", "trade_date"],
    "adj_factor": ["stock_code", "trade_date"],
    "minute": ["stock_code", "datetime"],
    "finance": ["stock_code", "report_date"],
    "doc": ["stock_code", "trade_date"],
}
_YEAR_OF = {"daily": "trade_date", "minute": "datetime"}
# Reports lie in so many buckets of their codes' hashes.
DOC_BUCKETS = 64
# Landed rows may be stamped so long before they can be read.
ARRIVAL_LAG = "1 day"
_RULES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "stock_map": quality.dq_stock_map,
    "daily": lambda df: quality.null_rule(df, "silver.daily", "pre_close", "info"),
    "adj_factor": quality.dq_adj_factor,
    "minute": lambda df: quality.duplicate_rule(df, "silver.minute", _KEYS["minute"]),
    "finance": quality.dq_finance,
    "doc": quality.dq_doc,
}


@dataclass(frozen=True)
class Paths:
    """Roots of the landed and the cleaned tables; one folder per table below each."""

    bronze: str
    silver: str

    def raw(self, table: str) -> str:
        return f"{self.bronze}/{table}"

    def clean(self, target: str) -> str:
        return f"{self.silver}/{target}"


class _Job:
    """One target of one build: its inputs, its current version and its counters."""

    def __init__(self, spark: SparkSession, target: str, paths: Paths):
        self.spark, self.target, self.paths = spark, target, paths
        self.gate = Observation()
        self.written = Observation()
        self.landed: Observation | None = None  # the last arrival among the rows looked at
        self.gated = target in ("daily", "minute")
        self.years: list[int] | None = None  # years of a bar table this build wrote
        self.root = paths.clean(target)
        self.path = current_version(spark, self.root)

    def bronze(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.paths.raw(table))

    def optional(self, table: str) -> DataFrame | None:
        return self.bronze(table) if path_exists(self.spark, self.paths.raw(table)) else None

    @property
    def by(self) -> str | None:
        return {"daily": "year", "minute": "year", "doc": "bucket"}.get(self.target)

    @property
    def codec(self) -> str | None:
        return TEXT_CODEC if self.target == "doc" else None

    def current(self) -> DataFrame:
        table = read_version(self.spark, self.root, _SCHEMAS[self.target])
        if self.by and self.by not in table.columns:  # no partition was ever written
            table = table.withColumn(self.by, F.lit(None).cast("int"))
        return table

    def partitioned(self, df: DataFrame) -> DataFrame:
        """Rows with the column that their table is partitioned by."""
        if self.target == "doc":
            return df.withColumn("bucket", F.pmod(F.xxhash64("stock_code"), F.lit(DOC_BUCKETS)).cast("int"))
        return df.withColumn("year", F.year(_YEAR_OF[self.target]))

    def other(self, target: str) -> DataFrame:
        return read_version(self.spark, self.paths.clean(target), _SCHEMAS[target])

    # -- rows of the target, from all landed data or from a part of it

    def rows(self, day: str | None = None, codes: DataFrame | None = None) -> DataFrame:
        return getattr(self, f"_{self.target}")(day, codes)

    def _pick(self, df, key, codes, prefixed=False):
        if df is None or codes is None:
            return df
        if prefixed:
            codes = codes.select(code_to_prefixed_lookup(F.col("code")).alias("code"))
        return code_in_list(df, key, codes)

    def _daily(self, day, codes):
        primary = self._pick(self.bronze("daily_primary"), "stock_code", codes)
        secondary = self._pick(self.optional("daily_secondary"), "stock_code", codes, True)
        seed = None
        if day is not None:
            primary = date_prefix_filter(primary, "datetime", day)
            if secondary is not None:
                secondary = date_prefix_filter(secondary, "date", day)
            if self.path is not None:
                codes = silver.landed_codes(primary, secondary)
                seed = last_before(self.current(), "stock_code", "trade_date", day, codes).select(
                    "stock_code", F.col("close").alias("seed_close")
                )
        return silver.daily_bars(primary, secondary, seed, self.gate)[0]

    def _minute(self, day, codes):
        raw = self._pick(self.bronze("minute"), "stock_code", codes)
        if day is not None:
            raw = silver.since_marks(raw, self.marks(), ARRIVAL_LAG)
        if "ingested_at" in raw.columns and codes is None:
            self.landed = Observation()
            arrived = F.max(F.col("ingested_at").cast("timestamp_ntz"))
            raw = raw.observe(self.landed, arrived.cast("string").alias("arrived"))
        if day is not None:
            typed = raw.withColumn("__ts", F.col("datetime").try_cast("timestamp_ntz"))
            raw = newer_than_marks(typed, self.marks(), "stock_code", "__ts").drop("__ts")
        return silver.minute_bars(raw, self.gate)[0]

    # -- marks: (stock_code, mark, arrived), one row per code, stored with each version of the minute table

    def marks(self) -> DataFrame:
        """Marks of the current version; of one that has none, from the table itself."""
        path = self._marks_of(self.path)
        if path_exists(self.spark, path):
            return self.spark.read.schema("stock_code string, mark timestamp_ntz, arrived timestamp_ntz").parquet(path)
        own = marks_of(self.current(), "stock_code", "datetime")
        return own.withColumn("arrived", F.lit(None).cast("timestamp_ntz"))

    def _save_marks(self, marks: DataFrame, path: str, known: DataFrame | None) -> None:
        """Store the marks of a version that isn't visible yet."""
        seen = measured(self.landed, "arrived")["arrived"] if self.landed is not None else None
        before = None if known is None else known.agg(F.max("arrived").cast("string")).first()[0]
        arrived = max((t for t in (seen, before) if t), default=None)  # 0 where nothing was read
        rows = marks.select("stock_code", "mark", F.lit(arrived).cast("timestamp_ntz").alias("arrived"))
        write_version(rows.coalesce(1), f"{self.paths.silver}/marks/{self.target}", int(path.rsplit("v=", 1)[1]))
        drop_old_versions(self.spark, f"{self.paths.silver}/marks/{self.target}", keep=3)

    def _marks_of(self, path: str) -> str:
        return f"{self.paths.silver}/marks/{self.target}/{path.rsplit('/', 1)[1]}"

    def _adj_factor(self, day, codes):
        raw = self._pick(self.bronze("xdxr"), "code", codes)
        events = silver.corporate_actions(raw)
        if day is not None:
            events = new_keys_only(events, self.current(), _KEYS["adj_factor"])
        return silver.with_factor(events, self.other("daily"))

    def _finance(self, day, codes):
        return silver.finance_rows(self._pick(self.bronze("finance"), "code", codes))

    def _stock_map(self, day, codes):
        listed = silver.instruments(self.bronze("stocks"), self.bronze("finance"))
        listed = self._pick(listed, "stock_code", codes)
        if self.path is None or (day is None and codes is None):
            return surrogate_id(listed, "stock_code", name="stock_code_id")
        known = self.current().select("stock_code", "stock_code_id")
        top = known.select(F.coalesce(F.max("stock_code_id"), F.lit(0))).scalar()
        fresh = surrogate_id(
            new_keys_only(listed, known, ["stock_code"]), "stock_code", top, name="stock_code_id"
        )
        if codes is None:
            return fresh
        return fresh.unionByName(listed.join(known, "stock_code"))

    def _doc(self, day, codes):
        # reports landed as rows have an index, so unchanged texts are not even read
        indexed = self.paths.raw("docs_landed")
        if path_exists(self.spark, indexed):
            known = self.current() if day is not None else None
            docs = self._pick(landed_documents(self.spark, indexed, known), "stock_code", codes)
        else:
            docs = self._pick(
                read_documents(self.spark, self.paths.raw("docs")), "stock_code", codes
            )
            if day is not None:
                known = self.current().select(
                    "stock_code", F.col("source_hash").alias("file_hash")
                )
                docs = doc_changed(doc_hash(docs), known, "stock_code")
        return silver.changed_pages(docs, None if day is None else self.sections())

    # -- sections of reports, rendered: a second table in the same buckets

    def sections(self) -> DataFrame:
        return read_version(self.spark, f"{self.root}_section", DOC_SECTION).select(*DOC_SECTION.fieldNames())

    def _save_sections(self, pages: DataFrame, buckets: Sequence[int] | None) -> None:
        """Store the sections of new pages: of all, or in place of their reports' in the buckets given.

        They come before the pages, whose hashes decide what is rendered: if a build dies in between, the
        next one renders the same reports again.
        """
        root, rows = f"{self.root}_section", silver.page_sections(pages)
        if buckets is not None and current_version(self.spark, root) is not None:
            held = read_version(self.spark, root, DOC_SECTION)
            if "bucket" in held.columns:
                gone = pages.select("stock_code").distinct()
                held = held.filter(F.col("bucket").isin(list(buckets))).join(gone, "stock_code", "left_anti")
                rows = held.select(*DOC_SECTION.fieldNames()).unionByName(rows)
        write_parts(self.partitioned(rows), root, "bucket", ["stock_code", "section_no"], buckets, codec=TEXT_CODEC)
        drop_unused_parts(self.spark, root)

    # -- writing

    def _counted(self, df: DataFrame, *more: str) -> DataFrame:
        names = [*_SCHEMAS[self.target].fieldNames(), *more]
        span = []
        if self.target in _YEAR_OF:
            year = F.year(_YEAR_OF[self.target])
            span = [F.min(year).alias("first"), F.max(year).alias("last")]
        return df.select(*names).observe(self.written, F.count(F.lit(1)).alias("n"), *span)

    def _save_steps(self, codes: DataFrame | None = None) -> None:
        """Keep the step table of this version of the factors; only steps of the codes given are worked out anew."""
        root, factors = self.paths.clean("adj_step"), self.current().select(*ADJ_FACTOR.fieldNames())
        steps = factor_steps(factors) if codes is None else update_steps(read_version(self.spark, root, ADJ_STEP), factors, codes)
        write_version(steps, root, int(self.path.rsplit("v=", 1)[1]))
        drop_old_versions(self.spark, root)

    def _new_version(self, df: DataFrame) -> None:
        if self.by:
            self.path = write_parts(self.partitioned(df), self.root, self.by, _KEYS[self.target], codec=self.codec)
            drop_unused_parts(self.spark, self.root)
        else:
            self.path = write_version(df, self.root)
            drop_old_versions(self.spark, self.root)

    def full(self) -> None:
        if self.target == "doc":
            with self._staged(self._counted(self.rows(), "sections")) as pages:
                self._save_sections(pages, None)
                self._new_version(pages.drop("sections"))
            return
        self._new_version(self._counted(self.rows()))
        if self.target == "adj_factor":
            self._save_steps()
        if self.target == "minute":
            self._save_marks(marks_of(self.current(), "stock_code", "datetime"), self.path, None)

    def incremental(self, day: str) -> None:
        if self.target == "doc":
            self._change_parts(self.rows(day=day), lambda held, rows: upsert_update(held, rows, _KEYS["doc"]))
        elif self.target == "daily":
            self._add_day(day)
        elif self.target == "minute":  # later than the code's last bar, hence unseen
            known = self.marks()
            with self._staged(self._counted(self.rows(day=day))) as fresh:
                path = new_version(self.root)
                marks = merge_marks(known, marks_of(fresh, "stock_code", "datetime"), "stock_code")
                self._save_marks(marks, path, known)
                self._add(fresh, path=path)
        else:
            with self._staged(self._counted(new_rows(self.current(), self.rows(day=day), _KEYS[self.target]))) as fresh:
                steps = stored_steps(self.spark, self.paths) if self.target == "adj_factor" else None
                self._new_version(self.current().unionByName(fresh))
                if self.target == "adj_factor":
                    self._save_steps(None if steps is None else fresh.select("stock_code"))

    def _add(self, fresh: DataFrame, replaced: Sequence[int] = (), path: str | None = None) -> None:
        """A version with more rows, or with other rows in the years it replaces."""
        self.path = write_parts(self.partitioned(fresh), self.root, self.by, _KEYS[self.target], list(replaced), path, codec=self.codec)
        drop_unused_parts(self.spark, self.root)

    def _add_day(self, day: str) -> None:
        """Add a day's bars, and give each code's first bar after it its new previous close.

        Nothing is stored after the newest day, so the usual build ends with a look at the
        partitions from the day's year on.
        """
        stored, at = self.current(), F.lit(day).cast("date")
        same_day = stored.filter((F.col("year") == int(day[:4])) & (F.col("trade_date") == at))
        fresh = self._counted(new_rows(same_day, self.rows(day=day), _KEYS["daily"]))
        later = stored.filter((F.col("year") >= int(day[:4])) & (F.col("trade_date") > at))
        if later.isEmpty():
            self._add(fresh)
            return
        names = DAILY.fieldNames()
        with self._staged(fresh) as fresh:
            today = same_day.select(*names).unionByName(fresh).select("stock_code", F.col("close").alias("__close"))
            following = later.groupBy("stock_code").agg(F.min("trade_date").alias("trade_date"))
            wrong = (
                later.join(following, ["stock_code", "trade_date"]).join(today, "stock_code")
                .filter(~F.col("pre_close").eqNullSafe(F.col("__close")))
                .withColumn("pre_close", F.col("__close"))
                .withColumn("change_pct", change_pct(F.col("close"), F.col("pre_close")))
            )
            with self._staged(wrong.select(*names)) as wrong:
                years = [r[0] for r in wrong.select(F.year("trade_date")).distinct().collect()]
                held = stored.filter(F.col("year").isin(years)).select(*names)
                changed = upsert_update(held, wrong, _KEYS["daily"])
                self._add(changed.unionByName(fresh), years)

    @contextlib.contextmanager
    def _staged(self, df: DataFrame) -> Iterator[DataFrame]:
        """Rows stored while they are in use, so that they are worked out once."""
        folder = f"{self.paths.silver}/repair/{self.target}-{time.time_ns()}"
        df.write.parquet(folder, compression=self.codec)
        try:
            yield self.spark.read.schema(df.schema).parquet(folder)
        finally:
            remove_path(self.spark, folder)

    def repair(self, codes: DataFrame) -> None:
        # rebuilt rows come from landed tables only, never from the partitions replaced
        batch = self.rows(codes=codes)
        if self.target in ("adj_factor", "stock_map"):
            rows = self._counted(batch)
            self._new_version(upsert_update(self.current(), rows, _KEYS[self.target]))
            if self.target == "adj_factor":
                self._save_steps()
        elif self.target == "finance":
            rows = self._counted(batch)
            self._new_version(replace_keys(self.current(), rows, "stock_code", codes))
        else:
            held = code_in_list(self.current(), "stock_code", codes).select(self.by)
            self._change_parts(
                batch, lambda stored, rows: replace_keys(stored, rows, "stock_code", codes), held, codes
            )

    def _change_parts(
        self, batch: DataFrame, change, also: DataFrame | None = None, codes: DataFrame | None = None
    ) -> None:
        """A version with ``change`` of the partitions that rows of ``batch`` (and ``also``) lie in."""
        names = _SCHEMAS[self.target].fieldNames()
        known = self.marks() if self.target == "minute" else None
        sections = ["sections"] if self.target == "doc" else []
        with self._staged(self._counted(batch, *sections)) as rows:
            touched = self.partitioned(rows).select(self.by)
            touched = touched if also is None else touched.union(also)
            values = [r[0] for r in touched.distinct().collect()]  # one small number per year or bucket
            if not values:
                return
            if sections:
                self._save_sections(rows, values)
            stored, path = self.current().filter(F.col(self.by).isin(values)).select(*names), new_version(self.root)
            if known is not None:
                own = marks_of(rows, "stock_code", "datetime")
                kept = known.select("stock_code", "mark")
                self._save_marks(replace_keys(kept, own, "stock_code", codes), path, known)
            self._add(change(stored, rows.select(*names)), values, path)
            self.years = values

    def _written_years(self) -> list[int]:
        """Exactly the stored years that this build changed."""
        if self.years is not None:
            return self.years
        span = measured(self.written, "n")
        if not span["n"]:
            return []
        return [y for y in stored_years(self.spark, self.path) if span["first"] <= y <= span["last"]]

    def result(self, mode: str) -> DataFrame:
        # all issues are stored as a table; the result row has their number and its place
        written, table = measured(self.written, "n")["n"], self.current()
        if self.target == "minute":  # a full build has just made its keys unique
            table = table.filter(F.col("year").isin([] if mode == "full" else self._written_years()))
        found = _RULES[self.target](table)
        where = write_version(found, f"{self.paths.silver}/issues/{self.target}")
        drop_old_versions(self.spark, f"{self.paths.silver}/issues/{self.target}")
        issues = self.spark.read.schema(found.schema).parquet(where)
        levels = issues.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
        counts = {r["level"]: r["n"] for r in levels.collect()}
        shown = {
            level: [f"{counts[level]} of level {level} in {where}"]
            for level in counts if level in ("error", "warning")
        }
        gate = measured(self.gate, "read", "rejected") if self.gated else {"read": written, "rejected": 0}
        read, rejected = gate["read"], gate["rejected"]
        if rejected:
            shown.setdefault("warning", []).append(f"quality gate rejected {rejected} rows")
        if not counts.get("error"):
            status = "ok"
        else:
            status = "partial" if written > 0 else "fail"
        return _result(self.spark, self.target, mode, status, read, written, rejected,
                       shown.get("error", []), shown.get("warning", []))


def stored_steps(spark: SparkSession, paths: Paths) -> DataFrame | None:
    """The kept step table, if it is that of the current version of the factors."""
    factors, steps = (current_version(spark, paths.clean(t)) for t in ("adj_factor", "adj_step"))
    if factors is None or steps is None or factors.rsplit("/", 1)[1] != steps.rsplit("/", 1)[1]:
        return None
    return spark.read.schema(ADJ_STEP).parquet(steps)


def _result(spark, target, mode, status, read=0, written=0, rejected=0, errors=(), warnings=()):
    row = (target, mode, status, read, written, rejected, list(errors), list(warnings))
    return spark.createDataFrame([row], BUILD_RESULT)


def build_full(spark: SparkSession, target: str, paths: Paths) -> DataFrame:
    """Rebuild a target from all landed data."""
    job = _Job(spark, target, paths)
    job.full()
    return job.result("full")


def build_incremental(spark: SparkSession, target: str, paths: Paths, day: str) -> DataFrame:
    """Add what landed since; a target never built is built in full, finance always is."""
    job = _Job(spark, target, paths)
    if job.path is None or target == "finance":
        return build_full(spark, target, paths)
    job.incremental(day)
    return job.result("incremental")


def build_repair(
    spark: SparkSession, target: str, paths: Paths, codes: DataFrame | Sequence[str]
) -> DataFrame:
    """Rebuild the given codes; a target never built is built in full.

    Codes are a table, e.g. of ``failed_codes`` or ``repair_worklist`` (its column ``code``, or
    else its first), which never passes the driver; a list becomes one.
    """
    if not isinstance(codes, DataFrame):
        codes = spark.createDataFrame([(c,) for c in codes], "code string")
    column = "code" if "code" in codes.columns else codes.columns[0]
    codes = codes.select(F.col(column).alias("code")).filter(F.col("code").isNotNull()).distinct()
    if codes.isEmpty():
        return _result(spark, target, "repair", "skipped", errors=["repair mode requires codes"])
    job = _Job(spark, target, paths)
    if job.path is None:
        return build_full(spark, target, paths)
    job.repair(codes)
    return job.result("repair")


def build(
    spark: SparkSession,
    target: str,
    mode: str,
    paths: Paths,
    day: str | None = None,
    codes: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """One target in one mode; any error becomes a result row with status 'fail'."""
    try:
        if mode == "full":
            return build_full(spark, target, paths)
        if mode == "incremental":
            return build_incremental(spark, target, paths, day)
        if mode == "repair":
            return build_repair(spark, target, paths, [] if codes is None else codes)
    except Exception as error:  # noqa: BLE001 - reported, so that other targets still run
        return _result(spark, target, mode, "fail", errors=[str(error)])
    return _result(spark, target, mode, "skipped", errors=[f"unsupported mode: {mode}"])


def build_all(
    spark: SparkSession,
    mode: str,
    paths: Paths,
    day: str | None = None,
    codes: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """All targets in dependency order."""
    results = None
    for target in TARGETS:
        one = build(spark, target, mode, paths, day, codes)
        results = one if results is None else results.unionByName(one)
    return results
