"""Search by vector, structure and text, and the embedding step it rests on."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.text import contains_pattern, not_blank
from tidewrack.functions.vectors import cosine
from tidewrack.operators import graph, report
from tidewrack.session import cut

DEFAULT_MODEL = "multilingual-e5-large"
Embedder = Callable[[Sequence[str]], list[list[float]]]


def resolve_model(insights: DataFrame, requested: str | None = None, default: str = DEFAULT_MODEL) -> str:
    """The requested model, else that of the stored vectors, else the default; several or unknown stored models raise."""
    if requested:
        return requested
    have = [r["embedding_model"] for r in graph.models(insights).limit(2).collect()]
    if len(have) > 1 or have == [None]:
        raise ValueError("the stored vectors are of several models or of an unknown one; name the model")
    return have[0] if have else default


def ensure_matches(insights: DataFrame, model: str, dimension: int | None = None) -> None:
    """Raises unless all stored vectors are of the model and of one dimension (the given one)."""
    if [r for r in graph.models(insights).limit(2).collect() if r["embedding_model"] != model]:
        raise ValueError(f"stored vectors aren't all of {model}")
    have = [r["dimension"] for r in graph.dimensions(insights).limit(2).collect()]
    if len(have) > 1 or dimension and have and have != [dimension]:
        raise ValueError(f"stored vectors have dimensions {have}, the query {dimension}")


def filters(*, insight_type: str | None = None, domain: str | None = None, pain_level: int | None = None, monetizable: bool | None = None, platform: str | None = None, since: datetime | None = None, text: str | None = None) -> Column:
    """All given conditions together."""
    c = [F.col(k) == v for k, v in (("insight_type", insight_type), ("domain", domain), ("pain_level", pain_level), ("monetizable", monetizable), ("platform", platform)) if v is not None]
    if since is not None:
        c.append(F.col("posted_at") >= F.lit(since).cast("timestamp_ntz"))
    if text is not None:
        c.append(contains_pattern(F.col("text"), text))
    return reduce(lambda a, b: a & b, c, F.lit(True))


def search(insights: DataFrame, posts: DataFrame, query: Sequence[float], n: int = 20, model: str | None = None, **conditions) -> DataFrame:
    """The n insights nearest to a query vector that meet the conditions: (post_id, score, ...). Ties go to the lesser post_id. One pass over
    the vectors in the JVM, a bounded top-n per task."""
    ensure_matches(insights, resolve_model(insights, model), len(query))
    return ranked(insights, posts, query, n, **conditions)


def ranked(insights: DataFrame, posts: DataFrame, query: Sequence[float], n: int = 20, **conditions) -> DataFrame:
    """search() without its checks; vectors of another length have no score and are left out."""
    q = F.array(*[F.lit(float(x)) for x in query])
    rows = report.joined(insights.filter(F.size("embedding") == len(query)), posts).filter(filters(**conditions))
    rows = rows.withColumn("score", cosine(F.col("embedding"), q)).filter(F.col("score").isNotNull())
    return rows.select("post_id", "score", "insight_type", "domain", "summary", "platform", "url").orderBy(F.desc("score"), "post_id").limit(n)


def embed(insights: DataFrame, embedder: Embedder, model: str, n: int, prefix: str = "passage: ", batch: int = 64) -> DataFrame:
    """insights with vectors for the first n that lack one, by post_id. The embedder runs in Arrow batches and must give one vector per text,
    all of the dimension of the stored ones; otherwise this raises and nothing changes."""
    ensure_matches(insights, model)
    todo = insights.filter(F.col("embedding").isNull() & not_blank(F.col("summary"))).orderBy("post_id").limit(n).select("post_id", "summary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, out = b.column(0), b.column(1).to_pylist(), []
            for at in range(0, len(texts), batch):
                part = [prefix + t for t in texts[at : at + batch]]
                got = embedder(part)
                if len(got) != len(part):
                    raise ValueError(f"{len(got)} vectors for {len(part)} texts")
                out += got
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.list_(pa.float32()))], ["post_id", "new"])

    new = cut(todo.mapInArrow(run, "post_id string, new array<float>"))  # written, as a call of the embedder may be paid for
    sizes = {r["d"] for r in new.select(F.size("new").alias("d")).distinct().limit(2).collect()}
    have = {r["dimension"] for r in graph.dimensions(insights).limit(2).collect()}
    if len(sizes | have) > 1:
        raise ValueError(f"vectors of dimensions {sorted(sizes | have)}")
    return insights.join(new, "post_id", "left").withColumns({"embedding": F.coalesce("embedding", "new"), "embedding_model": F.when(F.col("new").isNotNull(), model).otherwise(F.col("embedding_model"))}).select(*insights.columns)


def embed_query(text: str, embedder: Embedder, prefix: str = "query: ") -> list[float]:
    return embedder([prefix + text])[0]
