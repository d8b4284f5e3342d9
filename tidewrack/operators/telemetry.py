"""Check events, collector logs and keyword quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.functions.text import pain
from tidewrack.functions.time import iso_utc

DISPLAY_RUNS = 20
#: Fixed value: the status of a decision record in force.
ACTIVE = "採用"


def keyword_quality(rows: DataFrame) -> DataFrame:
    """(keyword, count, pain_count, pain_rate) of (matched_keywords, text), most frequent first."""
    each = rows.select(F.explode("matched_keywords").alias("keyword"), pain(F.col("text")).alias("p"))
    stats = each.groupBy("keyword").agg(F.count("*").alias("count"), F.count_if("p").alias("pain_count"))
    return stats.withColumn("pain_rate", F.try_divide("pain_count", "count")).orderBy(F.desc("count"), "keyword")


def parse_events(lines: DataFrame, line: str = "value") -> DataFrame:
    """Events of JSON lines: ts, check and exit_code are required; other fields have defaults. Blank, broken and mistyped lines are left out.

    ts_instant orders events, ts_day is the date in the event's own offset (UTC without one), ts is the text as written.
    """
    e = F.from_json(line, "ts string, check string, context string, exit_code int, duration_ms long, violations long, rules array<string>")
    rows = lines.select(e.alias("e")).select("e.*").filter("ts IS NOT NULL AND check IS NOT NULL AND exit_code IS NOT NULL")
    rows = rows.withColumns({"ts_instant": iso_utc(F.col("ts")), "ts_day": F.substring("ts", 1, 10).try_cast("date")}).filter("ts_instant IS NOT NULL")
    none = F.array().cast("array<string>")
    return rows.withColumns({"context": F.coalesce("context", F.lit("unknown")), "duration_ms": F.coalesce("duration_ms", F.lit(0)), "violations": F.coalesce("violations", F.lit(0)), "rules": F.coalesce("rules", none)})


def in_order(events: DataFrame) -> DataFrame:
    """Events by time, as a listing shows them; statistics need no order."""
    return events.orderBy("ts_instant", "ts", "check")


def event_line(check: str, context: str, exit_code: int, duration_ms: int, output: str, ts: str) -> str:
    """The JSON line of one run of a check; rules are the ids its output names, in order and as often, the rest of the output is dropped."""
    import json
    import re

    rules = [x for x in re.findall(r"(?m)^NG: \[([a-z0-9-]*)\]", output) if x]
    return json.dumps({"ts": ts, "check": check, "context": context, "exit_code": exit_code, "duration_ms": duration_ms, "violations": len(rules), "rules": rules}, ensure_ascii=False)


def check_stats(events: DataFrame) -> DataFrame:
    """Per check: runs, blocks, violations, total_ms, block_rate, avg_ms (half to even), most blocks first."""
    s = events.groupBy("check").agg(F.count("*").alias("runs"), F.count_if(F.col("exit_code") != 0).alias("blocks"), F.sum("violations").alias("violations"), F.sum("duration_ms").alias("total_ms"))
    return s.withColumns({"block_rate": F.try_divide("blocks", "runs"), "avg_ms": F.bround(F.col("total_ms") / F.col("runs")).cast("bigint")}).orderBy(F.desc("blocks"), F.desc("runs"), "check")


def silent_checks(stats: DataFrame) -> DataFrame:
    return stats.filter("blocks = 0")


def rule_stats(events: DataFrame) -> DataFrame:
    """(rule, hits, last_seen): last_seen is the text of the latest event, as written."""
    rows = events.select(F.explode("rules").alias("rule"), "ts", "ts_instant")
    return rows.groupBy("rule").agg(F.count("*").alias("hits"), F.max_by("ts", F.struct("ts_instant", "ts")).alias("last_seen")).orderBy(F.desc("hits"), "rule")


def daily_runs(events: DataFrame, days: int = 30) -> DataFrame:
    """(day, runs, blocks) of the last days up to the latest event's, days without events with zeros. No event, no rows."""
    counts = events.groupBy(F.col("ts_day").alias("day")).agg(F.count("*").alias("runs"), F.count_if(F.col("exit_code") != 0).alias("blocks"))
    spine = counts.agg(F.max("day").alias("last")).filter("last IS NOT NULL").select(F.explode(F.sequence(F.date_sub("last", days - 1), F.col("last"))).alias("day"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("runs", F.lit(0)).alias("runs"), F.coalesce("blocks", F.lit(0)).alias("blocks")).orderBy("day")


def share_of_peak(value: Column) -> Column:
    """Percent of the greatest value of the result, 0 without a peak. One window over a result that is already aggregated."""
    peak = F.max(value).over(Window.partitionBy())
    return F.when(peak > 0, value / peak * 100).otherwise(F.lit(0.0))


def metrics_payload(events: DataFrame, days: int = 30) -> DataFrame:
    """(payload): the statistics as one JSON text. They are lists of checks, rules and days, not of events."""
    as_list = lambda df, order, name: df.agg(F.sort_array(F.collect_list(F.struct(*order, *[c for c in df.columns if c not in order]))).alias(name))
    checks, rules, by_day = as_list(check_stats(events), ["check"], "checks"), as_list(rule_stats(events), ["rule"], "rules"), as_list(daily_runs(events, days), ["day"], "daily")
    return checks.crossJoin(rules).crossJoin(by_day).select(F.to_json(F.struct("checks", "rules", "daily")).alias("payload"))


# The lines of a collector's log.
START, DONE = r"^\[([^\]]+)\]\s*start:\s*(\S+)", r"^\[([^\]]+)\]\s*done:\s*(\S+)"
RESULT = r"^\[([^:\]]+):([^\]]+)\]\s*取得:\s*(\d+)件\s*/\s*新規:\s*(\d+)件\s*/\s*スキップ:\s*(\d+)件"


def log_lines(files: DataFrame, text: str = "text") -> DataFrame:
    """(file, line_no, line, run_no, kind): the lines of whole log files (file, text). A start line opens a run; lines before any start are
    run 0; kind is start, done, result or note. Blank lines are left out. One row of files is one log, as its order counts."""
    lines = files.select("file", F.posexplode(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")).alias("line_no", "line")).filter(F.length(F.trim(F.regexp_replace("line", r"\s", " "))) > 0)
    kind = F.when(F.col("line").rlike(START), "start").when(F.col("line").rlike(DONE), "done").when(F.col("line").rlike(RESULT), "result").otherwise("note")
    return lines.withColumn("kind", kind).withColumn("run_no", F.sum(F.when(F.col("kind") == "start", 1).otherwise(0)).over(Window.partitionBy("file").orderBy("line_no")))


def log_results(lines: DataFrame) -> DataFrame:
    """(file, run_no, platform, keyword, fetched, added, skipped) of the result lines."""
    g = lambda i: F.regexp_extract("line", RESULT, i)
    return lines.filter("kind = 'result'").select("file", "run_no", g(1).alias("platform"), g(2).alias("keyword"), g(3).cast("bigint").alias("fetched"), g(4).cast("bigint").alias("added"), g(5).cast("bigint").alias("skipped"))


def log_runs(lines: DataFrame) -> DataFrame:
    """(file, run_no, started_at, finished_at, finished, fetched, added, notes)."""
    g = lambda i: F.regexp_extract("line", RESULT, i).try_cast("bigint")
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == "result", g(i))), F.lit(0)).alias(n) for i, n in ((3, "fetched"), (4, "added"))]
    started = F.max(F.when(F.col("kind") == "start", F.regexp_extract("line", START, 1)))
    ended = F.max_by(F.regexp_extract("line", DONE, 1), F.when(F.col("kind") == "done", F.col("line_no")))
    runs = lines.groupBy("file", "run_no").agg(started.alias("started_at"), ended.alias("finished_at"), *sums, F.count_if(F.col("kind") == "note").alias("notes"))
    return runs.withColumn("finished", F.col("finished_at").isNotNull())


def log_totals(runs: DataFrame) -> DataFrame:
    """Per file: runs, total_fetched, total_added, unfinished (not counting the last run, which may be under way)."""
    last = F.col("run_no") == F.max("run_no").over(Window.partitionBy("file"))
    return runs.withColumn("last", last).groupBy("file").agg(F.count("*").alias("runs"), F.sum("fetched").alias("total_fetched"), F.sum("added").alias("total_added"), F.count_if(~F.col("finished") & ~F.col("last")).alias("unfinished"))


def display_runs(runs: DataFrame, n: int = DISPLAY_RUNS) -> DataFrame:
    """The last n runs of each file, newest first, with whether there are more. The limit is the display's."""
    w = Window.partitionBy("file")
    return runs.withColumns({"position": F.row_number().over(w.orderBy(F.desc("run_no"))), "truncated": F.count("*").over(w) > n}).filter(F.col("position") <= n)


def keyword_summary(results: DataFrame) -> DataFrame:
    """(platform, keyword, fetched, added, runs) over all runs, least new first; platform is the log's name."""
    name = F.regexp_replace(F.regexp_extract("file", r"([^/]*)$", 1), r"\.log$", "")
    return results.groupBy(name.alias("platform"), "keyword").agg(F.sum("fetched").alias("fetched"), F.sum("added").alias("added"), F.count("*").alias("runs")).orderBy("added", F.desc("fetched"), "platform", "keyword")


def overview(posts: DataFrame, events: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """One row: posts collected, runs of checks, blocks, and decision records in force, where records (status) are given."""
    active = None if records is None else records.agg(F.count_if(F.col("status") == ACTIVE).alias("records_active"))
    one = posts.agg(F.count("*").alias("collected")).crossJoin(events.agg(F.count("*").alias("runs_total"), F.count_if(F.col("exit_code") != 0).alias("blocks_total")))
    return one if active is None else one.crossJoin(active)


def unrecorded(gates: DataFrame, stats: DataFrame) -> DataFrame:
    """Gates of (name, stage, is_check, interactive) that should leave events and have none."""
    return gates.filter((F.col("stage") == "pre-commit") & F.col("is_check") & ~F.col("interactive")).join(stats.select(F.col("check").alias("name")), "name", "left_anti")
