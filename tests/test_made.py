"""Queries over tables beyond the test tables' sizes and numbers give the rows of their SQL."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from tidewrack.operators import graph
from tidewrack.plans import made
from tidewrack.plans import reference as ref


def vectors(folder, x: np.ndarray) -> None:
    """A table of insights that have the vectors, named p0 and so on."""
    e = pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.float32).ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
    pq.write_table(pa.table({"post_id": [f"p{i}" for i in range(len(x))], "embedding": e, "embedding_model": [ref.MODEL] * len(x)}), f"{folder}/insights.parquet")


def test_batch_names_of_many_batches(spark, tmp_path):
    batches = [*range(75), 130, 4000, None, 7]
    spark.createDataFrame([(b,) for b in batches], "load_batch int").write.parquet(f"{tmp_path}/posts.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW posts AS SELECT * FROM read_parquet('{tmp_path}/posts.parquet/*.parquet')")
    got = [tuple(r) for r in made.queries()["batch_names"](spark, str(tmp_path)).collect()]
    assert got == con.execute(made.oracle_sql()["batch_names"]).fetchall() == [("20260812T000117",)]


def test_neighbour_floor_of_many_vectors(spark, tmp_path):
    x = np.random.default_rng(3).standard_normal((graph.MAX_VECTORS + 100, 64)).astype(np.float32)
    x[-300:] = x[:300] + np.float32(0.25) * x[300:600]
    vectors(tmp_path, x)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = sum(int((u[s : s + 500] @ u.T >= 0.95).sum()) for s in range(0, len(u), 500)) - len(u)
    assert want > 0 and made.queries()["neighbour_floor"](spark, str(tmp_path)).collect() == [(want // 2,)]


def test_similar_to_of_many_vectors(spark, data, tmp_path):
    n = graph.MAX_VECTORS + 100
    x = np.random.default_rng(4).standard_normal((n, 64)).astype(np.float32)
    x[-300:] = x[:300] + np.float32(0.25) * x[300:600]
    vectors(tmp_path, x)
    name = f"'p' || CASE WHEN k < 300 THEN k ELSE k + {n - 600} END"
    duckdb.sql(f"COPY (SELECT * EXCLUDE (k) REPLACE ({name} AS id) FROM (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS k FROM read_parquet('{data}/posts.parquet')) WHERE k < 600) TO '{tmp_path}/posts.parquet'")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = {tuple(sorted((f"p{i}", f"p{n - 300 + i}"))): round(float(u[i] @ u[n - 300 + i]), 4) for i in range(300)}
    got = ref.queries()["similar_to"](spark, str(tmp_path)).collect()
    assert {(r["src_id"], r["dst_id"]): r["weight"] for r in got} == want and len(got) == 300
