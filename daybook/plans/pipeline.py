"""The pipeline runs: one date, many dates (backfill) in one job, mart load, gates.

Stages pass state only through the written tables, like the reference's tasks:
Silver is written and read back (the barrier that keeps Gold from re-parsing
CSV), Gold is written per arrival date, and the mart is loaded from Gold.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import gold as gold_ops
from daybook.operators import parts, quality
from daybook.operators import silver as silver_ops
from daybook.schema import (GOLD_COLUMNS, GOLD_SCHEMA, MART_COLUMNS, SILVER_COLUMNS,
                            SILVER_SCHEMA)
from daybook.session import configure, session_sized_for
from daybook.sources import bronze, file_index, fs, headers, layers, mart, versions

log = logging.getLogger("daybook.pipeline")

GOLD_KEYS = ["process_date", "event_date"]


class GateError(ValueError):
    """A quality gate failed; later steps were not run."""


@dataclass(frozen=True)
class Paths:
    bronze: str
    silver: str
    gold: str
    mart: str

    @classmethod
    def under(cls, root: str, bronze_root: str | None = None) -> "Paths":
        root = root.rstrip("/")
        return cls(bronze=bronze_root or f"{root}/bronze/raw/events",
                   silver=f"{root}/silver/events",
                   gold=f"{root}/gold/daily_metrics",
                   mart=f"{root}/mart/daily_metrics")

    @property
    def files(self) -> str:
        """The index of the Bronze files that were taken in."""
        return f"{self.silver.rstrip('/')}_files"

    @property
    def revenue_parts(self) -> str:
        return f"{self.gold.rstrip('/')}_parts/revenue"

    @property
    def user_parts(self) -> str:
        return f"{self.gold.rstrip('/')}_parts/users"


@dataclass
class RunResult:
    dates: list[str]
    missing: list[str] = field(default_factory=list)
    cleared_silver: list[str] = field(default_factory=list)
    cleared_gold: list[str] = field(default_factory=list)
    reused_silver: list[str] = field(default_factory=list)
    reused_gold: list[str] = field(default_factory=list)


def normalize_dates(dates) -> list[str]:
    """ISO ``YYYY-MM-DD`` text, each date once, in the given order (bad text raises)."""
    if isinstance(dates, str):
        dates = [dates]
    return list(dict.fromkeys(dt.date.fromisoformat(str(d)).isoformat() for d in dates))


def date_range(start: str, end: str) -> list[str]:
    """Every ISO date from ``start`` to ``end``, both included."""
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [(a + dt.timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]


def silver_for(spark: SparkSession, paths: Paths, dates) -> DataFrame:
    """Silver rows of ``dates`` (all dates when None) with ``process_date``."""
    return layers.read_layer(spark, paths.silver, SILVER_SCHEMA, dates)


def gold_for(spark: SparkSession, paths: Paths, dates=None) -> DataFrame:
    """Gold rows of ``dates`` (all dates when None) with ``process_date``."""
    return layers.read_layer(spark, paths.gold, GOLD_SCHEMA, dates)


def silver_plan(spark: SparkSession, paths: Paths, dates, rebalance: bool = False,
                by_name: bool = False) -> DataFrame:
    """Cleaned Bronze of ``dates``: one scan for any number of dates, no shuffle.

    A task writes a file for each date it reads, so Silver has at most as many files as
    Bronze has files and splits. ``rebalance`` brings the rows of a date together first
    (AQE splits large dates and merges small ones): fewer files where Bronze has very many
    small ones, for the price of one shuffle of all rows. ``by_name`` binds columns by each
    file's header instead of by position.
    """
    read = headers.read_by_name if by_name else bronze.read_bronze
    cleaned = silver_ops.transform_to_silver(read(spark, paths.bronze, dates))
    return cleaned.hint("rebalance", "process_date") if rebalance else cleaned


def revenue_parts_for(spark: SparkSession, paths: Paths, dates=None) -> DataFrame:
    """Stored revenue parts of the arrival dates (all when None)."""
    return layers.read_layer(spark, paths.revenue_parts, parts.REVENUE_SCHEMA, dates)


def user_sets_for(spark: SparkSession, paths: Paths, dates=None) -> DataFrame:
    """Stored user sets of the arrival dates (all when None)."""
    return layers.read_layer(spark, paths.user_parts, parts.USERS_SCHEMA, dates)


def parts_plans(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(revenue parts, user sets) of Silver rows, a file or more for each arrival date."""
    return (gold_ops.revenue_parts(silver, GOLD_KEYS).hint("rebalance", "process_date"),
            parts.user_sets(silver, GOLD_KEYS).hint("rebalance", "process_date"))


def gold_plan(spark: SparkSession, paths: Paths, dates) -> DataFrame:
    """Gold from the stored parts of ``dates``: a row per date pair, one file per arrival date."""
    daily = parts.arrival_gold(revenue_parts_for(spark, paths, dates), user_sets_for(spark, paths, dates))
    return daily.repartition("process_date")


def metric_dates(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row for each metric date over all its arrival dates, from the stored parts."""
    return parts.metric_dates(revenue_parts_for(spark, paths), user_sets_for(spark, paths))


def _made_from(spark: SparkSession, root: str) -> dict[str, str | None]:
    return {d: e.made_from for d, e in versions.read_state(spark, root).dates.items()}


def _unchanged_bronze(spark: SparkSession, paths: Paths, seen: dict) -> None:
    """Raise if files came or went while they were read: rows and index would not agree."""
    now = file_index.delivered(file_index.list_files(spark, paths.bronze, list(seen)))
    if now != seen:
        changed = sorted(d for d in seen if now.get(d) != seen[d])
        raise GateError(f"Bronze files changed during the run, nothing was replaced: {changed}")


def _observed(df: DataFrame, dates, columns, check=None):
    """(df, notes): rows and digest of each date, taken while ``df`` is written.

    ``notes`` runs ``check`` first, if given, and gives the facts that go into the commit.
    """
    digest = quality.WriteDigest(dates, columns)

    def notes() -> dict[str, dict]:
        if check:
            check()
        return digest.by_date()

    return digest.observe(df), notes


def _remember_files(spark: SparkSession, paths: Paths, made_from: dict[str, str]) -> None:
    """Bring the index to the files that the dates' Silver was made from, where it differs."""
    known = _made_from(spark, paths.files)
    dates = [d for d, x in made_from.items() if known.get(d) != x]
    if dates:
        files = file_index.list_files(spark, paths.bronze, dates)
        file_index.remember(spark, files, paths.files, {d: made_from[d] for d in dates})


def _write_parts(spark: SparkSession, paths: Paths, dates, silver: DataFrame,
                 made_from: dict[str, str]) -> None:
    """Both tables of parts of ``silver``: jobs that don't wait for each other."""
    tables = zip((paths.revenue_parts, paths.user_parts), parts_plans(silver))
    fs.map_paths(lambda t: layers.replace_dates(spark, t[1], t[0], dates, made_from=made_from), tables)


def _write_gold(spark: SparkSession, paths: Paths, dates, made_from: dict[str, str]) -> list[str]:
    """The Gold rows that the stored parts of ``dates`` make."""
    rows, notes = _observed(gold_plan(spark, paths, dates), dates, GOLD_COLUMNS[1:])
    return layers.replace_dates(spark, rows, paths.gold, dates, made_from=made_from, notes=notes)


def run_silver(spark: SparkSession, paths: Paths, dates, rebalance: bool = False,
               resume: bool = False, by_name: bool = False) -> tuple[RunResult, dict, SparkSession]:
    """Bronze → Silver: the first half of :func:`run_dates`.

    Returns the result so far, what each date has (``file_index.Delivered``), and the session
    of the run, whose shuffle partitions follow the input's size.
    """
    configure(spark)
    asked = normalize_dates(dates)
    listed = file_index.list_files(spark, paths.bronze, asked)
    seen = file_index.delivered(listed)
    have, missing = [d for d in asked if d in seen], [d for d in asked if d not in seen]
    result = RunResult(dates=have, missing=missing)
    if missing:
        log.warning("no Bronze files for %d date(s): %s", len(missing), missing)
    if not have:
        return result, seen, spark
    input_bytes = sum(x.bytes for x in seen.values())
    own = configure(session_sized_for(spark, input_bytes))
    log.info("run %d date(s) %s..%s: %d Bronze bytes in %d files, %s shuffle partitions",
             len(have), have[0], have[-1], input_bytes, sum(x.files for x in seen.values()),
             own.conf.get("spark.sql.shuffle.partitions"))
    if resume:
        done = _made_from(spark, paths.silver)
        result.reused_silver = [d for d in have if done.get(d) == seen[d].fingerprint]
    todo = [d for d in have if d not in result.reused_silver]
    if todo:
        rows, notes = _observed(silver_plan(own, paths, todo, rebalance, by_name), todo, SILVER_COLUMNS,
                                lambda: _unchanged_bronze(own, paths, {d: seen[d] for d in todo}))
        try:
            with bronze.header_errors():
                result.cleared_silver = layers.replace_dates(
                    own, rows, paths.silver, todo, notes=notes,
                    made_from={d: seen[d].fingerprint for d in todo})
        except bronze.HeaderError as e:
            raise GateError(f"Bronze header check failed: {e}") from e
    return result, seen, own


def run_dates(spark: SparkSession, paths: Paths, dates, rebalance: bool = False,
              resume: bool = False, by_name: bool = False) -> RunResult:
    """Bronze → Silver → parts → Gold for many arrival dates: one job a table.

    Dates without Bronze files are reported in ``missing`` and skipped. A Bronze file with a
    wrong header, or files that change while they are read, fail the run before anything is
    replaced. The commits name the files a date was made from: with ``resume`` a date whose
    Silver (or parts and Gold) was made from the files that are there is not made again, so
    a run that stopped goes on where it stopped. With ``by_name`` files may have their columns
    in any order, or some missing (see ``sources.headers``).
    """
    result, seen, own = run_silver(spark, paths, dates, rebalance, resume, by_name)
    files = {d: x.fingerprint for d, x in seen.items()}
    if resume:
        steps = [_made_from(spark, p) for p in (paths.revenue_parts, paths.user_parts, paths.gold)]
        result.reused_gold = [d for d in result.dates if all(s.get(d) == files[d] for s in steps)]
    todo = [d for d in result.dates if d not in result.reused_gold]
    made_from = {d: files[d] for d in todo}
    jobs = [lambda: _remember_files(own, paths, {d: files[d] for d in result.dates})]
    if todo:
        jobs.append(lambda: _write_parts(own, paths, todo, silver_for(own, paths, todo), made_from))
    fs.map_paths(lambda job: job(), jobs)
    if todo:
        result.cleared_gold = _write_gold(own, paths, todo, made_from)
    log.info("cleared Silver %s, Gold %s", result.cleared_silver, result.cleared_gold)
    return result


def apply_late_files(spark: SparkSession, paths: Paths, dates=None) -> RunResult:
    """Take in the Bronze files that came since their dates were run, and only those.

    The new files' rows and parts are added beside what their dates have, and Gold of those
    dates is made by merging the stored parts: neither Bronze nor Silver is read again. A date
    that was not run yet, whose known files changed or went, or whose tables do not agree
    (a run stopped between them) is run in full. Without new files nothing is written.
    """
    configure(spark)
    asked = None if dates is None else normalize_dates(dates)
    listed = file_index.list_files(spark, paths.bronze, asked)
    known = file_index.known_files(spark, paths.files, asked)
    late = file_index.late_files(listed, known)
    by_date = {r["process_date"].isoformat(): r["changed"] for r in
               late.groupBy("process_date").agg(F.bool_or("changed").alias("changed")).collect()}
    known_as = file_index.delivered(known)
    tables = [_made_from(spark, p) for p in (paths.silver, paths.revenue_parts, paths.user_parts)]
    agrees = {d for d, x in known_as.items() if all(t.get(d) == x.fingerprint for t in tables)}
    added = sorted(d for d, changed in by_date.items() if d in agrees and not changed)
    whole = sorted((by_date.keys() | (known_as.keys() - agrees)) - set(added))
    gold = _made_from(spark, paths.gold)
    stale = sorted(d for d in agrees - by_date.keys() if gold.get(d) != known_as[d].fingerprint)
    result = run_dates(spark, paths, whole) if whole else RunResult(dates=[])
    if stale:  # a run stopped before Gold
        _write_gold(spark, paths, stale, {d: known_as[d].fingerprint for d in stale})
        result.dates += stale
    if not added:
        return result
    seen = {d: x for d, x in file_index.delivered(listed).items() if d in added}
    files = {d: x.fingerprint for d, x in seen.items()}
    new = late.where(F.col("process_date").cast("string").isin(added)).select(
        "process_date", "path", "length", "modified")
    names = [r["path"] for r in new.select("path").collect()]  # the new files of this call
    own = configure(session_sized_for(spark, sum(x.bytes for x in seen.values())))
    try:
        with bronze.header_errors():
            rows = silver_ops.transform_to_silver(bronze.read_files(own, paths.bronze, names))
            written = layers.write_version(rows, paths.silver)
    except bronze.HeaderError as e:
        raise GateError(f"Bronze header check failed: {e}") from e
    _unchanged_bronze(own, paths, seen)
    # a file without a good row adds no folder, but its date is made from it all the same
    folders = {d: [written[d]] if d in written else [] for d in added}
    new_rows = layers.read_layer(own, paths.silver, SILVER_SCHEMA, folders=list(written.values()))
    revenue, users = parts_plans(new_rows)
    parts_written = [(paths.silver, folders)]
    for root, plan in ((paths.revenue_parts, revenue), (paths.user_parts, users)):
        at = layers.write_version(plan, root)
        parts_written.append((root, {d: [at[d]] if d in at else [] for d in added}))
    for root, by in parts_written:
        versions.commit(own, root, {d: versions.Entry(f, files[d]) for d, f in by.items()}, append=True)
    _remember_files(own, paths, files)
    result.cleared_gold += _write_gold(own, paths, added, files)
    result.dates += added
    return result


def plans_for(spark: SparkSession, paths: Paths, dates) -> dict[str, DataFrame]:
    """The Silver and Gold DataFrames a run of ``dates`` would write (not executed).

    Parts and Gold are planned over the current Silver and parts of those dates; for ``explain()``.
    """
    configure(spark)
    have, _ = bronze.present_dates(spark, paths.bronze, normalize_dates(dates))
    revenue, users = parts_plans(silver_for(spark, paths, have))
    return {"silver": silver_plan(spark, paths, have), "revenue parts": revenue, "user sets": users,
            "gold": gold_plan(spark, paths, have)}


def daily_run(spark: SparkSession, paths: Paths, date: str) -> RunResult:
    """The run for one arrival date; a missing Bronze date is an error."""
    bronze.require_bronze(spark, paths.bronze, date)
    return run_dates(spark, paths, [date])


def backfill(spark: SparkSession, paths: Paths, start: str, end: str,
             resume: bool = False) -> RunResult:
    """All arrival dates from ``start`` to ``end`` in one job per layer.

    With ``resume``, dates that an earlier run has finished are not made again.
    """
    return run_dates(spark, paths, date_range(start, end), resume=resume)


def load(spark: SparkSession, paths: Paths, dates, jdbc_url: str | None = None,
         jdbc_table: str = "daily_metrics", jdbc_props: dict | None = None) -> list[str]:
    """Publish Gold rows of ``dates`` to the mart (replace per date).

    With ``jdbc_url`` they go to a relational mart too, in one transaction.
    """
    configure(spark)
    dates = normalize_dates(dates)
    if jdbc_url:
        from daybook.sources import jdbc
        jdbc.load_mart_jdbc(spark, gold_for(spark, paths, dates), jdbc_url, dates, jdbc_table,
                            jdbc_props)
    rows, notes = _observed(mart.mart_rows_from_gold(gold_for(spark, paths, dates)), dates, MART_COLUMNS)
    cleared = layers.replace_dates(spark, rows, paths.mart, dates, notes=notes)
    log.info("mart loaded for %d date(s); cleared %s", len(dates), cleared)
    return cleared


def check_layers(spark: SparkSession, paths: Paths, date: str) -> dict[str, int]:
    """Gate: Silver and Gold of the date must both have rows."""
    counts = {
        "silver": silver_for(spark, paths, [date]).count(),
        "gold": gold_for(spark, paths, [date]).count(),
    }
    if counts["silver"] == 0 or counts["gold"] == 0:
        raise GateError(f"Silver or Gold layer is empty for {date}: {counts}")
    return counts


def check_mart_count(spark: SparkSession, paths: Paths, date: str,
                     expected: int | None = None) -> int:
    """Gate: the mart holds as many rows for the metric date as Gold, and at least one.

    Gold has one row for each arrival date that brought events of the date, so a row
    that was loaded twice, or not at all, is found. ``expected`` overrides that count.
    """
    from daybook.operators import dashboard
    n = dashboard.count_by_date(mart.mart_view(spark, paths.mart), date).first()["row_count"]
    if expected is None:
        gold = gold_for(spark, paths).withColumnRenamed("event_date", "metric_date")
        expected = max(1, dashboard.count_by_date(gold, date).first()["row_count"])
    if n != expected:
        raise GateError(f"mart has {n} rows for {date}, expected {expected}")
    return n


def rerun_report(spark: SparkSession, paths: Paths, dates) -> DataFrame:
    """Run and load ``dates`` again: (layer, process_date, row_count, unchanged).

    Compares the digests that stand in the commits of before and after, which were taken
    while the rows were written. No layer is read for it.
    """
    from functools import reduce
    dates = list(dates)
    roots = {"silver": paths.silver, "gold": paths.gold, "mart": paths.mart}
    before = {k: versions.read_state(spark, r).number for k, r in roots.items()}
    done = run_dates(spark, paths, dates)
    load(spark, paths, done.dates)
    of_dates = F.col("process_date").cast("string").isin(normalize_dates(dates))

    def digests(layer: str, number: int) -> DataFrame:
        return versions.state_frame(spark, roots[layer], number).where(of_dates)

    return reduce(DataFrame.unionByName, [
        quality.changed_dates(digests(k, n), digests(k, versions.read_state(spark, roots[k]).number))
        .select(F.lit(k).alias("layer"), "*") for k, n in before.items()])


def verify_idempotent(spark: SparkSession, paths: Paths, dates) -> dict[str, int]:
    """Run and load the dates again; per layer, the number of dates whose rows changed."""
    counts = (rerun_report(spark, paths, dates).groupBy("layer")
              .agg(F.count_if(~F.col("unchanged")).alias("n")).collect())  # three rows
    return {layer: 0 for layer in ("silver", "gold", "mart")} | {r["layer"]: r["n"] for r in counts}


def header_report(spark: SparkSession, paths: Paths, dates=None) -> DataFrame:
    """A row for each Bronze file: its header and what differs from the declared columns (Q8)."""
    listed = file_index.list_files(spark, paths.bronze, None if dates is None else normalize_dates(dates))
    return headers.header_report(headers.read_headers(spark, paths.bronze, listed))


# The report checks a run must pass; the others are reported, not enforced.
REQUIRED_CHECKS = ("bronze_rows", "silver_rows", "gold_rows", "rows_reconciled",
                   "silver_null_keys", "amount_summable")


def quality_report(spark: SparkSession, paths: Paths, dates=None):
    """The per-date quality report over all four layers (see operators.quality.report)."""
    if dates is not None:
        dates = normalize_dates(dates)
    return quality.report(bronze.read_bronze_checked(spark, paths.bronze, dates),
                          silver_for(spark, paths, dates), gold_for(spark, paths, dates),
                          mart.mart_view(spark, paths.mart), dates)


def check_report(spark: SparkSession, paths: Paths, dates, required=REQUIRED_CHECKS) -> list:
    """Gate: raise when a required check fails for one of the dates.

    Collects only the failed rows of the required checks (at most dates × checks).
    """
    dates = list(dates)
    rep = quality_report(spark, paths, dates)
    failed = (rep.where(F.col("check").isin(list(required)) & ~F.col("passed"))
              .select("process_date", "check", "observed", "expected").collect())
    if failed:
        raise GateError(f"quality checks failed: {[tuple(r) for r in failed]}")
    return failed


def run_gated(spark: SparkSession, paths: Paths, date: str, generate=None,
              steps: dict | None = None, **jdbc) -> dict:
    """generate → Bronze present → transform → layers not empty → load.

    Each step runs only when the one before succeeded; a failed gate raises.
    ``generate`` is an optional callable ``(spark, paths, date)`` that writes Bronze.
    ``jdbc`` options go to :func:`load`. The results go into ``steps``, if given, as they come: after a failed gate it holds
    the steps before it.
    """
    steps = {} if steps is None else steps
    if generate is not None:
        generate(spark, paths, date)
        steps["generate"] = True
    steps["bronze_files"] = bronze.require_bronze(spark, paths.bronze, date)
    steps["run"] = run_dates(spark, paths, [date])
    steps["layers"] = check_layers(spark, paths, date)
    steps["load"] = load(spark, paths, [date], **jdbc)
    steps["mart_rows"] = check_mart_count(spark, paths, date)
    return steps
