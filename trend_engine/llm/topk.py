"""Exact top-k search by inner product with a pivot table.

Vectors are lifted by one component to equal length (queries by 0), so that a higher inner product
is a smaller distance. Every vector carries its distances to ``PIVOTS`` pivots; the largest
difference of two such lists is a lower bound of the distance (triangle inequality). Per query,
candidates are evaluated in order of their bounds until the next bound exceeds the distance of the
k-th best: what is left can't be among the best, so the result is exact.

Queries and vectors are dealt into blocks by hash; every query block meets every vector block in a
cell of its own (bounded rows), which returns each query's best k; k rows per cell are merged.

Cases: vectors that are null, empty or hold null or non-finite components take no part; shorter
vectors count as filled up with zeros; a query never finds rows of its own id; ties go to the
smaller id; of fewer candidates all come; rows equal in id and vector are one query, but each is a
candidate; without vectors or queries the result is empty; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trend_engine.llm._common import table

PIVOTS, SAMPLE = 24, 512
#: Rows of a block of vectors, of queries.
BLOCK, QUERIES = 8192, 2048
#: Whole numbers below these are exact in double and in single precision, in sums of any order.
_SAFE, _SINGLE = float(1 << 52), float(1 << 24)


def scaled(embedding: Column, factor: float = 64.0) -> Column:
    """floor(factor * x) of every component, as doubles."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * factor).cast("double"))


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(embedding) > 0) & finite, F.lit(False))


def pivots(vectors: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Vectors far from each other: each the farthest from those before it."""
    chosen = [0]
    gap = ((vectors - vectors[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(vectors)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((vectors - vectors[chosen[-1]]) ** 2).sum(1))
    return vectors[chosen]


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def bounds(far: np.ndarray, dq: np.ndarray) -> np.ndarray:
    """The largest difference to `dq` in each column of `far` (a row per pivot)."""
    out = np.abs(far[0] - dq[0])
    gap = np.empty_like(out)
    for row, d in zip(far[1:], dq[1:], strict=True):
        np.subtract(row, d, out=gap)
        np.abs(gap, out=gap)
        np.maximum(out, gap, out=out)
    return out


def best(x: np.ndarray, ids: np.ndarray, far: np.ndarray, q: np.ndarray, own: int, dq: np.ndarray, k: int, length2: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores, evaluated) of the k best candidates of one query, by bounds from the pivot table.

    `far`: the candidates' distances, a row per pivot, in single precision; the reach is widened by
    more than that rounding, so the stop stays exact. Scores are whole numbers, exact in x's type.
    """
    bound = bounds(far, dq)
    slack = 1e-6 * (1 + float(np.abs(dq).max()) + float(bound.max()))
    step = min(len(ids), max(4 * k, 128))
    order = np.argpartition(bound, step - 1)[:step]
    rest = None
    got_ids, got, done, q2 = np.empty(0, np.int64), np.empty(0), 0, float(np.square(q, dtype=float).sum())
    while len(order):
        part = order[ids[order] != own]
        done += len(part)
        score = (np.take(x, part, 0) @ q).astype(float)
        if len(got) == k:  # those below the k-th can't come in
            up = score >= got[-1]
            part, score = part[up], score[up]
        got_ids, got = np.concatenate([got_ids, ids[part]]), np.concatenate([got, score])
        keep = np.lexsort((got_ids, -got))[:k]
        got_ids, got = got_ids[keep], got[keep]
        reach = math.inf if len(got) < k else math.sqrt(max(0.0, q2 + length2 - 2 * got[-1])) * (1 + 1e-6) + slack
        if rest is None:  # the others that the first ones leave open, by bound
            others = bound <= reach
            others[order] = False
            rest = np.flatnonzero(others)
            rest = rest[np.argsort(bound[rest], kind="stable")]
        step = min(2 * step, 2048)
        order, rest = rest[:step], rest[step:]
        order = order[: np.searchsorted(bound[order], reach, side="right")]
    return got_ids, got, done


def top_k(rows: DataFrame, queries: Column, k: int = 20, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score of rows (vec_id, vector of whole doubles); `queries` picks the
    rows that are searched for."""
    rows = table(rows, "topk-vectors")
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("l"), F.max(F.size("vector")).alias("d"),
                     F.sum(queries.cast("long")).alias("q")).first()
    width, length2 = facts.d or 1, facts.l or 0.0
    some = [r.vector for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()]
    low = _matrix(pd.Series(some, dtype=object), width)
    lifted = np.hstack([low, np.sqrt(np.maximum(0, length2 - (low**2).sum(1)))[:, None]])
    table_of = pivots(lifted) if len(lifted) else np.zeros((1, width + 1))

    @F.pandas_udf("array<double>")
    def to_pivots(vectors: pd.Series, query: pd.Series) -> pd.Series:
        v = _matrix(vectors, width)
        own = (v**2).sum(1)
        last = np.where(query, 0.0, np.sqrt(np.maximum(0, length2 - own)))
        square = own + last**2
        across = v @ table_of[:, :-1].T + last[:, None] * table_of[:, -1]
        return pd.Series(list(np.sqrt(np.maximum(0, square[:, None] + (table_of**2).sum(1) - 2 * across))))

    db, qb = max(1, math.ceil(facts.n / block)), max(1, math.ceil((facts.q or 0) / query_block))
    name = F.xxhash64("vec_id", "vector")
    data = rows.select(F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("qb"), F.pmod(name, F.lit(db)).cast("int").alias("db"),
                       F.lit(False).alias("query"), "vec_id", "vector")
    ask = rows.where(queries).dropDuplicates(["vec_id", "vector"]).select(
        F.pmod(name, F.lit(qb)).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(db - 1))).alias("db"),
        F.lit(True).alias("query"), "vec_id", "vector")
    cells = data.unionByName(ask).withColumn("far", to_pivots("vector", "query")).withColumn("name", name)

    def cell(g: pd.DataFrame) -> pd.DataFrame:
        x, far = _matrix(g["vector"], width), _matrix(g["far"], len(table_of))
        query, ids = g["query"].to_numpy(bool), g["vec_id"].to_numpy(np.int64)
        out = []
        cids, cfar = ids[~query], np.ascontiguousarray(far[~query].T, np.float32)
        most = np.abs(x).max(initial=0) ** 2 * width
        exact = most < _SAFE
        x = x.astype(np.float32) if most < _SINGLE else x  # whole sums either way
        far, cx = far.astype(np.float32), x[~query]
        if not exact:  # sums beyond a double's whole numbers: Python's integers
            cx = np.array([[int(c) for c in r] for r in cx], object).reshape(-1, width)
        for i in np.flatnonzero(query) if len(cids) else []:
            if exact:
                got, score, _ = best(cx, cids, cfar, x[i], ids[i], far[i], k, length2)
            else:
                score = cx @ np.array([int(c) for c in x[i]], object)
                order = [j for j in sorted(range(len(cids)), key=lambda j: (-score[j], cids[j])) if cids[j] != ids[i]][:k]
                got, score = cids[order], [max(-(1 << 63), min((1 << 63) - 1, s)) for s in score[order]]
            out += [(ids[i], g["name"].iloc[i], v, int(s)) for v, s in zip(got, score, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "name", "vec_id", "score"])

    near = cells.groupBy("qb", "db").applyInPandas(cell, "query_id long, name long, vec_id long, score long")
    order = Window.partitionBy("query_id", "name").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return near.select("query_id", "rank", "vec_id", "score")


def op2_topk(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    return top_k(rows.select(F.col("vec_id").cast("long"), scaled(F.col("embedding")).alias("vector")), F.col("vec_id") % 20 == 0)
