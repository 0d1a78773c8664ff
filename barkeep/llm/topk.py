"""Exact top-k inner products by columnar branch-and-bound.

Vectors are packed into blocks with one column per dimension. A block of queries meets every
block of candidates; per query, scores are added up some dimensions at a time, and after each
step only those candidates stay whose score so far plus the largest amount the remaining
dimensions can give (the product of the remaining lengths) still reaches the k-th best lower
bound. Survivors are compacted, so later dimensions touch few of them. Each pair of
blocks yields k rows a query at most; a window keeps the k best overall.

Vectors that are null, or have a null or non-finite component, or no id, take no part;
neither do vectors of another length than the query's. Repeated candidate rows count as rows,
repeated queries as one; a query never meets rows of its own id, as these cannot be told from its own row.
A scaled component beyond 2^53, or a pair of vectors whose score might not fit a long, is an error.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from barkeep.llm.batches import to_batch
from barkeep.scratch import stage

CANDIDATES, QUERIES, STEP = 4096, 512, 16

# Components beyond this are no longer counted exactly by the whole numbers of a double.
LARGEST = 2.0**53

_PACKED = pa.schema([("dims", pa.int32()), ("ids", pa.binary()), ("keys", pa.binary()), ("values", pa.binary())])
_FOUND = pa.schema(
    [("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
)


def quantized(vectors, scale=64, id_col="vec_id", vector_col="embedding"):
    """``vec_id`` and whole-numbered ``v`` of the vectors that take part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    complaint = F.lit(f"a component times {scale} is beyond 2^53")
    whole = lambda e: F.when(F.abs(e * scale) <= LARGEST, F.floor(e * scale)).otherwise(F.raise_error(complaint))
    rows = (
        vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
        .select("vec_id", F.transform("x", whole).alias("v"))
    )
    # Tells queries of one id apart, whatever numbers a block is computed in.
    return rows.withColumn("key", F.xxhash64("v"))


def _packed(vectors, size, label):
    """Rows packed ``size`` at a time, dimension by dimension, without a shuffle."""

    def run(batches):
        for batch in batches:
            lists = batch.column("v")
            dims = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            ids, keys = batch.column("vec_id").to_numpy(), batch.column("key").to_numpy()
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                for part in np.split(rows, range(size, len(rows), size)):
                    values = flat[starts[part][:, None] + np.arange(d)] if d else np.empty((len(part), 0), np.int64)
                    raw = np.ascontiguousarray(values.T).tobytes()
                    yield to_batch(_PACKED, [d], [ids[part].tobytes()], [keys[part].tobytes()], [raw])

    packed = vectors.mapInArrow(run, "dims int, ids binary, keys binary, values binary")
    return stage(packed.withColumn("part", F.monotonically_increasing_id()), label)


def _best(query, own, candidates, ids, rest, k, step, seeds):
    """Places and scores of the k best candidates of one query in a block."""
    d, n = candidates.shape
    # Lengths of the query beyond each step, a little enlarged so that rounding never drops a row.
    edges = list(range(0, d, step)) + [d]
    lengths = [np.sqrt((query[e:].astype(np.float64) ** 2).sum()) * (1 + 1e-9) for e in edges]
    place = np.flatnonzero(ids != own)
    bound = -np.inf
    if len(place) > 4 * k and len(seeds):
        first = query @ candidates[:, seeds]
        first = first[ids[seeds] != own]
        if len(first) >= k:
            bound = np.partition(first, len(first) - k)[len(first) - k]
    # In the query's own numbers: beyond 2^53 doubles would round.
    score = np.zeros(len(place), query.dtype)
    for number, (low, high) in enumerate(zip(edges, edges[1:])):
        part = candidates[low:high] if len(place) == n else candidates[low:high, place]
        score = score + query[low:high] @ part
        if high < d:
            slack = lengths[number + 1] * rest[number + 1][place]
            if len(place) > k:
                floor = score - slack
                bound = max(bound, np.partition(floor, len(floor) - k)[len(floor) - k])
            stays = score + slack >= bound - 0.25 - abs(bound) * 1e-14
            place, score = place[stays], score[stays]
    order = np.lexsort((ids[place], -score))[:k]
    return place[order], score[order]


def top_k(vectors, queries, k=20, scale=64, id_col="vec_id", vector_col="embedding"):
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's k best rows of ``vectors``."""
    rows = _packed(quantized(vectors, scale, id_col, vector_col), CANDIDATES, "candidates")
    asked = quantized(queries, scale, id_col, vector_col).dropDuplicates(["vec_id", "v"])
    asks = _packed(asked, QUERIES, "queries")
    numbered = rows.select("part", "dims", F.row_number().over(Window.orderBy("part")).alias("block"))
    blocks = rows.count()
    rows = rows.join(numbered.select("part", "block"), "part").select("block", "dims", "ids", "values")
    met = asks.select(
        F.explode(F.sequence(F.lit(1), F.lit(max(1, blocks)))).alias("block"),
        "dims",
        F.col("ids").alias("query_ids"),
        F.col("keys").alias("query_keys"),
        F.col("values").alias("queries"),
    )
    pairs = met.join(rows.hint("shuffle_hash"), ["block", "dims"]).select(
        "dims", "ids", "values", "query_ids", "query_keys", "queries"
    )

    def run(batches):
        for batch in batches:
            for pair in batch.to_pylist():
                yield _search(pair, k)

    found = pairs.mapInArrow(run, "query_id long, query_key long, vec_id long, score long")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search(pair, k):
    d = pair["dims"]
    ids, own, keys = (np.frombuffer(pair[c], np.int64) for c in ("ids", "query_ids", "query_keys"))
    whole, asked = (np.frombuffer(pair[c], np.int64).reshape(d, -1) for c in ("values", "queries"))
    kind = np.float64
    if d and float(np.abs(whole).max()) * float(np.abs(asked).max()) * d >= 2**52:
        kind = np.int64  # beyond what doubles add exactly; bounds stay conservative
    columns, asked = whole.astype(kind), np.ascontiguousarray(asked.astype(kind).T)
    squares = columns.astype(np.float64) ** 2
    edges = list(range(0, d, STEP)) + [d]
    rest = [np.sqrt(squares[e:].sum(axis=0)) * (1 + 1e-9) for e in edges]
    longest = np.sqrt((asked.astype(np.float64) ** 2).sum(axis=1).max(initial=0))
    if longest * rest[0].max(initial=0) >= 2.0**63:
        raise ValueError("the score of two vectors may not fit a long")
    seeds = np.argsort(-rest[0])[: 4 * k]
    out = [[], [], [], []]
    for query, own_id, key in zip(asked, own.tolist(), keys.tolist()):
        place, score = _best(query, own_id, columns, ids, rest, k, STEP, seeds)
        out[0].append(np.full(len(place), own_id))
        out[1].append(np.full(len(place), key))
        out[2].append(ids[place])
        out[3].append(np.rint(score).astype(np.int64) if kind is np.float64 else score.astype(np.int64))
    arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in out]
    return pa.RecordBatch.from_arrays(arrays, schema=_FOUND)
