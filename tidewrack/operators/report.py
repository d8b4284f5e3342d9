"""Period reports: counts, representatives, newcomers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.text import markdown_cell, signed, space_trim
from tidewrack.functions.time import in_period
from tidewrack.sources import paths


def example(value: str, at: str, key: str) -> Column:
    """The value of the latest row that has one; ties go to the greater key, rows without a time don't count."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull() & F.col(at).isNotNull(), F.struct(F.col(at), F.col(key))))


def joined(insights: DataFrame, posts: DataFrame) -> DataFrame:
    """insights with their posts."""
    return insights.join(posts.withColumnRenamed("id", "post_id"), "post_id")


def daily_counts(posts: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """(platform, day, count) of posts collected in the period."""
    return posts.filter(in_period(F.col("collected_at"), since, until)).groupBy("platform", F.to_date("collected_at").alias("day")).agg(F.count("*").alias("count")).orderBy("day", "platform")


def type_counts(both: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """(insight_type, count, example_url) of insights extracted in the period."""
    return both.filter(in_period(F.col("extracted_at"), since, until)).groupBy("insight_type").agg(F.count("*").alias("count"), example("url", "posted_at", "post_id").alias("example_url")).orderBy(F.desc("count"), "insight_type")


def domain_counts(both: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """(domain, count, previous_count, example_url): the period against the equally long one before it, in one pass; domains of the period only."""
    before = since - (until - since)
    now = in_period(F.col("extracted_at"), since, until)
    rows = both.filter(in_period(F.col("extracted_at"), before, until) & F.col("domain").isNotNull()).withColumn("now_url", F.when(now, F.col("url")))
    counts = rows.groupBy("domain").agg(F.count_if(now).alias("count"), F.count_if(~now).alias("previous_count"), example("now_url", "posted_at", "post_id").alias("example_url"))
    return counts.filter("count > 0").orderBy(F.desc("count"), "domain")


def top_signals(both: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """All insights of the period of the greatest pain that somebody would pay for, latest posts first."""
    rows = both.filter(in_period(F.col("extracted_at"), since, until) & (F.col("pain_level") == 3) & F.col("monetizable"))
    return rows.orderBy(F.desc_nulls_last("posted_at"), "post_id").select("post_id", "platform", "url", "summary", "domain")


def keywords(posts: DataFrame) -> DataFrame:
    """(id, keyword, posted_at, ...) one row per keyword of a post."""
    return posts.withColumn("keyword", F.explode("matched_keywords"))


def top_keywords(posts: DataFrame, since: datetime, until: datetime, n: int) -> DataFrame:
    """The n most frequent keywords of the period. The limit is the feature: a report's top list."""
    return keywords(posts.filter(in_period(F.col("collected_at"), since, until)).select("matched_keywords")).groupBy("keyword").agg(F.count("*").alias("count")).orderBy(F.desc("count"), F.asc_nulls_last("keyword")).limit(n)


def keyword_pairs(posts: DataFrame) -> DataFrame:
    """(id, a, b, ...) pairs of different keywords of one post, a < b, without repeats: formed inside each row, without a join or shuffle."""
    words = F.array_sort(F.array_distinct(F.array_compact("matched_keywords")))
    pairs = F.flatten(F.transform(words, lambda a: F.transform(F.filter(words, lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return posts.filter(F.size("matched_keywords") > 1).withColumn("p", F.explode(pairs)).withColumns({"a": F.col("p.a"), "b": F.col("p.b")}).drop("p")


def top_keyword_pairs(posts: DataFrame, since: datetime, until: datetime, n: int) -> DataFrame:
    """The n most frequent pairs of keywords of the period."""
    rows = keyword_pairs(posts.filter(in_period(F.col("collected_at"), since, until)).select("id", "matched_keywords"))
    return rows.groupBy(F.col("a").alias("keyword_a"), F.col("b").alias("keyword_b")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "keyword_a", "keyword_b").limit(n)


def mentions(both: DataFrame) -> DataFrame:
    """One row per product named, trimmed, blanks left out; a name twice in a list counts twice."""
    return both.withColumn("product", F.explode("competitors")).withColumn("product", space_trim(F.col("product"))).filter(F.length("product") > 0)


def new_competitors(both: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """(product, first_seen, example_url): products whose first mention ever is in the period; the example is the latest of all mentions."""
    rows = mentions(both).groupBy("product").agg(F.min("extracted_at").alias("first_seen"), example("url", "posted_at", "post_id").alias("example_url"))
    return rows.filter(in_period(F.col("first_seen"), since, until)).orderBy("first_seen", "product")


def opportunities(both: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """Insights of the period other than none, greatest pain first."""
    rows = both.filter(in_period(F.col("extracted_at"), since, until) & (F.col("insight_type") != "none"))
    return rows.orderBy(F.desc_nulls_last("pain_level"), "post_id").select("post_id", "insight_type", "domain", "summary", "pain_level", "monetizable", "competitors", "url")


# The sections of a report file: name, heading and titles of the columns (none: a list), and the text of an empty section.
SECTIONS = (
    ("daily_counts", "新規観測件数（プラットフォーム別・日次）", ("日付", "platform", "件数")),
    ("type_counts", "insight_type別の分布", ("insight_type", "件数", "代表投稿")),
    ("domain_counts", "domain別の件数（前期間比）", ("domain", "件数", "前期間", "差分", "代表投稿")),
    ("top_signals", "最重要シグナル（pain_level=3 かつ monetizable=true の全件）", ()),
    ("top_keywords", "頻出キーワード", ("キーワード", "件数")),
    ("keyword_pairs", "キーワード共起 上位", ("キーワードA", "キーワードB", "件数")),
    ("new_competitors", "新規に観測された競合製品", ("製品", "初出", "代表投稿")),
)
TITLE, EMPTY = "定期レポート", "該当なし"
NOTE = "この節までは決定論的な集計のみ。洞察・仮説の加筆は `prompts/report-insights.md` の作業指示に従い別セッションで行う。"


def section_lines(name: str, df: DataFrame) -> DataFrame:
    """(line): the lines of a section, in the order of df."""
    cell, number = lambda c: markdown_cell(F.col(c)), lambda c: F.col(c).cast("string")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    cells = {
        "daily_counts": lambda: (day("day"), cell("platform"), number("count")),
        "type_counts": lambda: (cell("insight_type"), number("count"), cell("example_url")),
        "domain_counts": lambda: (cell("domain"), number("count"), number("previous_count"), signed(F.col("count") - F.col("previous_count")), cell("example_url")),
        "top_keywords": lambda: (cell("keyword"), number("count")),
        "keyword_pairs": lambda: (cell("keyword_a"), cell("keyword_b"), number("count")),
        "new_competitors": lambda: (cell("product"), day("first_seen"), cell("example_url")),
    }
    if name in cells:
        return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells[name]()), F.lit(" |")).alias("line"))
    summary = F.coalesce(F.when(F.col("summary") != "", markdown_cell(F.col("summary"))), F.col("post_id"))
    first = F.concat(F.lit("- ["), cell("platform"), F.lit("/"), cell("domain"), F.lit("] "), summary)
    return df.select(F.concat_ws("\n", first, F.when(F.col("url") != "", F.concat(F.lit("  "), F.col("url")))).alias("line"))


def write(parts: dict[str, DataFrame], folder: str, since: datetime, until: datetime) -> str:
    """Writes the report as one Markdown file in the folder, in place of one of the same days, and gives its path. parts: as build() gives
    them; their lines are written by tasks and don't pass through the driver's memory."""
    spark = next(iter(parts.values())).sparkSession
    out: list[str | DataFrame] = [f"# {TITLE} {since:%Y-%m-%d} 〜 {until:%Y-%m-%d}\n\n{NOTE}\n\n"]
    for name, heading, titles in SECTIONS:
        lines = section_lines(name, parts[name])
        head = f"| {' | '.join(titles)} |\n{'|---' * len(titles)}|\n" if titles else ""
        out += [f"## {heading}\n\n", *([f"{EMPTY}\n"] if lines.isEmpty() else [head, lines]), "\n"]
    path = f"{folder.rstrip('/')}/{file_name(since, until)}"
    paths.write_one(spark, path, out)
    return path


def build(posts: DataFrame, insights: DataFrame, since: datetime, until: datetime, n: int = 10) -> dict[str, DataFrame]:
    """All parts of a report."""
    both = joined(insights, posts)
    return {
        "daily_counts": daily_counts(posts, since, until), "type_counts": type_counts(both, since, until), "domain_counts": domain_counts(both, since, until),
        "top_signals": top_signals(both, since, until), "top_keywords": top_keywords(posts, since, until, n), "keyword_pairs": top_keyword_pairs(posts, since, until, n),
        "new_competitors": new_competitors(both, since, until),
    }


def file_name(since: datetime, until: datetime) -> str:
    return f"report-{since:%Y-%m-%d}_{until:%Y-%m-%d}.md"
