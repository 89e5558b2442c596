"""Exact top-k search by term-at-a-time accumulation (operator 10).

Vectors become whole numbers, floor(scale * x). Queries and candidates are dealt into
blocks of bounded size, and each pair of a query block and a candidate block meets in
one task: for each term of a query its postings (candidates with a value other than
0) add their weighted values to a dense array of scores. Each block keeps its best k
per query; these few rows are merged by rank.

Defined cases: vectors that are null, or hold a null or non-finite component, take no
part; missing components of shorter vectors count 0; rows with the query's own id are
no candidates; repeated query rows are searched each for itself; ties go to the
smaller id; scores are exact however large the components are: where sums may leave
64 bits a block counts in Python integers, and a returned score beyond 64 bits is an
error; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, CANDIDATE_BLOCK = 2_048, 16_384
#: Below this doubles have fractions; from it on all are whole.
ALL_WHOLE = float(2**53)


def usable(vector: Column) -> Column:
    """True if the vector and all its components are there and finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole(vector: Column, scale: float) -> Column:
    """floor(scale * x) as doubles, which hold these whole numbers exactly; a product beyond all doubles is an error."""

    def one(x: Column) -> Column:
        y = F.lit(scale) * x.cast("double")
        far = F.when(F.abs(y) < float("inf"), y).otherwise(F.raise_error(F.lit("a component is too large")).cast("double"))
        return F.when(F.abs(y) < ALL_WHOLE, F.floor(y).cast("double")).otherwise(far)

    return F.transform(vector, one)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    if isinstance(rows, pa.ChunkedArray):
        rows = pa.concat_arrays(rows.chunks)
    sizes = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    at = np.arange(out.shape[1])
    out[at[None, :] < sizes[:, None]] = rows.flatten().to_numpy()
    return out


def _integers(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if no sum of products can leave them, else as Python integers."""
    width = min(queries.shape[1], candidates.shape[1])
    most = np.abs(queries[:, :width]).max(axis=0, initial=0) @ np.abs(candidates[:, :width]).max(axis=0, initial=0)
    if most < 2**62 and max(np.abs(queries).max(initial=0), np.abs(candidates).max(initial=0)) < 2**62:
        return queries.astype(np.int64), candidates.astype(np.int64)
    exact = np.frompyfunc(int, 1, 1)
    return exact(queries), exact(candidates)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to the smaller id, best first."""
    if len(scores) > k:
        place = len(scores) - k
        least = np.sort(scores)[place] if scores.dtype == object else np.partition(scores, place)[place]
        at = np.flatnonzero(scores > least)
        ties = np.flatnonzero(scores == least)
        ties = ties[np.argsort(ids[ties], kind="stable")][: k - len(at)]
        at = np.r_[at, ties]
    else:
        at = np.arange(len(scores))
    return np.array(sorted(at.tolist(), key=lambda i: (-scores[i], ids[i])), dtype=np.int64)


def search_block(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of this block for each query of this block."""
    out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
    if queries.num_rows and candidates.num_rows:
        ids = candidates["vec_id"].to_numpy()
        terms, values = _integers(_matrix(queries["vector"]), _matrix(candidates["vector"]))
        values = np.ascontiguousarray(values.T)
        # A posting list: where the term occurs (None: everywhere) and its values there.
        postings = [(None, v) if v.all() else (np.flatnonzero(v), v[v != 0]) for v in values]
        terms = terms[:, : len(postings)]
        scores = np.empty(len(ids), dtype=values.dtype)
        for row, q, weights in zip(queries["query_row"].to_pylist(), queries["vec_id"].to_pylist(), terms):
            scores[:] = 0
            for t in np.flatnonzero(weights):
                where, v = postings[t]
                if where is None:
                    scores += weights[t] * v
                else:
                    scores[where] += weights[t] * v
            fit = np.flatnonzero(ids != q)
            at = fit[_best(scores[fit], ids[fit], k)]
            out["query_row"] += [row] * len(at)
            out["query_id"] += [q] * len(at)
            out["vec_id"] += ids[at].tolist()
            out["score"] += scores[at].tolist()
    return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score of each query row's k best rows of ``vectors`` (vec_id, embedding)."""
    def prepared(df: DataFrame) -> DataFrame:
        return df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select("vec_id", whole(F.col("embedding"), scale).alias("vector"))

    n_query = queries.count() // QUERY_BLOCK + 1
    n_candidate = vectors.count() // CANDIDATE_BLOCK + 1
    each = F.monotonically_increasing_id()
    # Odd numbers of blocks mix the partition number in the high bits with the row number.
    n_query, n_candidate = n_query | 1, n_candidate | 1
    q = prepared(queries).withColumn("query_row", each)
    q = q.withColumns({"qb": F.pmod("query_row", F.lit(n_query)), "cb": F.explode(F.sequence(F.lit(0), F.lit(n_candidate - 1)))})
    c = prepared(vectors).withColumn("row", each)
    c = c.select("vec_id", "vector", F.pmod("row", F.lit(n_candidate)).cast("int").alias("cb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_query - 1).cast("long"))).alias("qb"))
    cells = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb"))
    found = cells.applyInArrow(lambda a, b: search_block(a, b, k), "query_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
