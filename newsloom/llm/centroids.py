"""Exact integer k-means over subvector dictionaries.

Vectors are cut into blocks of neighbouring dimensions. A chunk of vectors keeps, for every
block, a dictionary of its distinct subvectors and one code per vector: a lossless encoding that
is written once and read in every round. In a round the exact distance of every distinct
subvector to every centroid's block is computed once per chunk, and a vector's distance is the
sum of its codes' partial distances. New centroids come from the codes too: a cluster's sum is
the count of each code times its subvector.

Dictionaries belong to chunks of bounded size, so no table of all distinct subvectors has to be
gathered or broadcast, whatever values occur. Between rounds only the centroids travel.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import Staging, spread

LARGEST = 1 << 27  # of a component: 64 squared differences of such values still fit 63 bits
_CHUNK = "ids array<long>, dictionaries array<binary>, codes array<binary>"
_SUMS = "cluster int, n long, distance decimal(38,0), sums array<decimal(38,0)>"
_ASSIGNED = "vec_id long, cluster int, distance long"


@dataclass(frozen=True)
class CentroidOptions:
    """``clusters`` centroids over vectors of ``dims`` components, ``rounds`` updates.

    A component x counts as the integer floor(``scale`` * x). ``block`` dimensions share a
    dictionary; ``chunk`` vectors are encoded together.
    """

    clusters: int = 16
    rounds: int = 3
    dims: int = 64
    scale: int = 64
    block: int = 2
    chunk: int = 16384


def _kept(vectors: DataFrame, options: CentroidOptions, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, v`` with integer components, of the vectors that count."""
    named = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = named.where((F.size("x") == options.dims) & F.coalesce(finite, F.lit(False)))
    scaled = F.transform("x", lambda x: F.floor(x * float(options.scale)))
    fits = F.forall("x", lambda x: F.abs(x * float(options.scale)) < float(LARGEST))
    message = f"a component times {options.scale} is {LARGEST} or more: distances would not fit 64 bits"
    return kept.select("vec_id", F.when(fits, scaled).otherwise(F.raise_error(F.lit(message)).cast("array<long>")).alias("v"))


def _encoded(options: CentroidOptions):
    """Dictionaries and codes of ``options.chunk`` vectors at a time."""
    size = options.block

    def packed(ids: list, rows: list) -> pa.RecordBatch:
        matrix = np.concatenate(rows)
        dictionaries, codes = [], []
        for low in range(0, options.dims, size):
            distinct, code = np.unique(matrix[:, low : low + size], axis=0, return_inverse=True)
            dictionaries.append(distinct.astype(np.int32).tobytes())
            codes.append(code.astype(np.uint16 if len(distinct) <= 1 << 16 else np.uint32).tobytes())
        kinds = [pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary())]
        columns = [[sum(ids, [])], [dictionaries], [codes]]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["ids", "dictionaries", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, held = [], [], 0
        for batch in batches:
            for low in range(0, batch.num_rows, options.chunk):
                part = batch.slice(low, options.chunk)
                if held + part.num_rows > options.chunk:
                    yield packed(ids, rows)
                    ids, rows, held = [], [], 0
                ids.append(part.column(0).to_pylist())
                rows.append(part.column(1).flatten().to_numpy().reshape(-1, options.dims))
                held += part.num_rows
        if held:
            yield packed(ids, rows)

    return run


def _assigned(row: dict, centroids: np.ndarray, options: CentroidOptions) -> tuple[np.ndarray, np.ndarray, list]:
    """Nearest centroid (the smaller number on ties), squared distance, and the decoded blocks."""
    blocks, total = [], np.zeros((len(row["ids"]), len(centroids)), dtype=np.int64)
    for i, (dictionary, codes) in enumerate(zip(row["dictionaries"], row["codes"], strict=True)):
        low, high = i * options.block, min((i + 1) * options.block, options.dims)
        distinct = np.frombuffer(dictionary, dtype=np.int32).reshape(-1, high - low).astype(np.int64)
        code = np.frombuffer(codes, dtype=np.uint16 if len(distinct) <= 1 << 16 else np.uint32)
        partial = ((distinct[:, None, :] - centroids[None, :, low:high]) ** 2).sum(axis=2)
        total += partial[code]
        blocks.append((distinct, code))
    nearest = total.argmin(axis=1)
    return nearest, total[np.arange(len(total)), nearest], blocks


def _summing(centroids: np.ndarray, options: CentroidOptions):
    """Per chunk and cluster: vectors, distance and component sums, as exact decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = pa.decimal128(38, 0)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                nearest, distance, blocks = _assigned(row, centroids, options)
                for cluster in np.unique(nearest).tolist():
                    mine = nearest == cluster
                    sums = [np.bincount(code[mine], minlength=len(distinct)) @ distinct for distinct, code in blocks]
                    far = sum(distance[mine].tolist())
                    out.append((cluster, int(mine.sum()), far, np.concatenate(sums).tolist()))
            kinds = [pa.int32(), pa.int64(), wide, pa.list_(wide)]
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["cluster", "n", "distance", "sums"])

    return run


def _listing(centroids: np.ndarray, options: CentroidOptions):
    """The cluster and distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nearest, distance, _ = _assigned(row, centroids, options)
                columns = [pa.array(row["ids"], pa.int64()), pa.array(nearest, pa.int32()), pa.array(distance, pa.int64())]
                yield pa.record_batch(columns, names=["vec_id", "cluster", "distance"])

    return run


def _sums(chunks: DataFrame, centroids: np.ndarray, options: CentroidOptions) -> dict[int, tuple[int, int, list[int]]]:
    """Vectors, distance and component sums of every cluster: one row per cluster."""
    partial = chunks.mapInArrow(_summing(centroids, options), _SUMS)
    sums = F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(options.dims)])
    found = partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("distance").alias("distance"), sums.alias("sums"))
    return {r.cluster: (int(r.n), int(r.distance), [int(x) for x in r.sums]) for r in found.collect()}


def _first_centroids(kept: DataFrame, options: CentroidOptions) -> np.ndarray:
    """The vectors with the smallest hash of their id, in that order."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    named = kept.where("vec_id IS NOT NULL")
    narrow = named.select("vec_id", key.alias("key")).orderBy("key").limit(options.clusters)
    ids = sorted({r.vec_id for r in narrow.collect()})
    if not ids:
        return np.zeros((0, options.dims), dtype=np.int64)
    rows = named.where(F.col("vec_id").isin(ids)).select(key.alias("key"), "v").orderBy("key", "v").limit(options.clusters)
    return np.array([r.v for r in rows.collect()], dtype=np.int64)


def clustered(
    vectors: DataFrame, options: CentroidOptions | None = None, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` for every vector that counts.

    Vectors with exactly ``options.dims`` components, none null or not finite, count; the others
    and null vectors are left out. The vectors with the smallest SHA-256 of ``1:<vec_id>`` are the
    first centroids (rows that repeat an id follow each other by their components; a row without
    an id is assigned but never is a first centroid). Each round assigns all vectors, ties to the
    smaller number, and moves every centroid with vectors to their componentwise floor(sum/count).
    With fewer vectors than clusters there are fewer clusters. An empty table, and one without
    any id, gives no rows. A component too large for 64-bit distances ends the job with a message.
    Other columns are not read. The result reads staged chunks in the folder named by
    ``spark.checkpoint.dir``.
    """
    options = options or CentroidOptions()
    spark = vectors.sparkSession
    kept = _kept(vectors, options, id_column, vector_column)
    chunks = Staging(spark)(spread(kept).mapInArrow(_encoded(options), _CHUNK), "chunks")
    centroids = _first_centroids(kept, options)
    schema = f"{_ASSIGNED}, cluster_inertia long, inertia long, centroid array<long>"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    for _ in range(options.rounds):
        for cluster, (n, _, sums) in _sums(chunks, centroids, options).items():
            centroids[cluster] = [x // n for x in sums]
    last = _sums(chunks, centroids, options)
    total = sum(distance for _, distance, _ in last.values())
    facts = spark.createDataFrame(
        [(cluster, distance, total, centroids[cluster].tolist()) for cluster, (_, distance, _) in last.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    found = chunks.mapInArrow(_listing(centroids, options), _ASSIGNED)
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def oracle(options: CentroidOptions | None = None) -> str:
    """The same rounds as DuckDB SQL over ``embeddings``."""
    o = options or CentroidOptions()
    steps = [f"""vectors AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({o.scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {o.dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, v AS c FROM vectors
  QUALIFY cluster < {o.clusters}
)"""]
    for i in range(o.rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
  FROM vectors, c{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
)""")
        if i < o.rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS m
    FROM (SELECT cluster, d, sum(x)::BIGINT AS s, count(*) AS n
          FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM a{i}) GROUP BY ALL)
    GROUP BY cluster) USING (cluster)
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{o.rounds} JOIN c{o.rounds} USING (cluster)
"""
