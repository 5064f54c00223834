"""Near-duplicate vectors by p-stable hashing, checked by exact cosine.

Normalised vectors are projected on random directions (a Gaussian is 2-stable), shifted and cut
into steps of one width; several such numbers are the key of a bucket, and several tables of
buckets give close vectors several chances to meet. Members of a bucket are compared by exact
cosine in double precision.

Cosine 0.9 is a distance of 0.447 between unit vectors. With steps of 2 one hash of such a pair
agrees with probability 0.82 and one of unrelated vectors with 0.49, so with the settings below
a pair at the threshold is found with probability 1 - (1 - 0.82^10)^36 = 0.995, closer ones more
often, and a bucket holds 0.07 % of unrelated vectors. For much larger tables raise ``hashes`` with
the logarithm of the rows, and ``tables`` to keep the probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.blocks import components, dealt, join_labels, runs
from concord.llm.common import query, table
from concord.session import stage

COSINE = 0.9
TABLES, HASHES, WIDTH, SEED = 36, 10, 2.0, 42
#: Vectors in a chunk of a bucket.
CHUNK = 1_500


class Hasher:
    """The random projections for vectors of one length, from the seed."""

    def __init__(self, size: int, tables: int, hashes: int, width: float, seed: int) -> None:
        draw = np.random.default_rng([seed, size])
        self.directions = draw.standard_normal((size, tables * hashes)) / width
        self.shifts = draw.random(tables * hashes)
        self.mixers = draw.integers(1, 1 << 62, hashes) * 2 + 1
        self.shape = (-1, tables, hashes)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """One key per row and table. (Steps are mixed into 64 bits; a chance collision only adds a candidate.)"""
        steps = np.floor(unit @ self.directions + self.shifts).astype(np.int64).reshape(self.shape)
        with np.errstate(over="ignore"):
            mixed = (steps * self.mixers).sum(axis=2)
            return mixed ^ (mixed >> 29)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows in double precision."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # keeps extreme values in range
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def bucket_members(classes: DataFrame, tables: int, hashes: int, width: float, seed: int) -> DataFrame:
    """``table, key, cid, n, vector`` for every class and table. Vectors of other lengths never share a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers: dict[int, Hasher] = {}
        for batch in batches:
            sizes = np.array(batch["size"].to_pylist(), np.int64)
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                hasher = hashers.setdefault(size, Hasher(size, tables, hashes, width, seed))
                keys = hasher.keys(matrix(part["vector"]))
                for t in range(tables):
                    columns = [pa.array(np.full(part.num_rows, t, np.int32)), part["size"], pa.array(keys[:, t]), part["cid"], part["n"], part["vector"]]
                    yield pa.RecordBatch.from_arrays(columns, names=["table", "size", "key", "cid", "n", "vector"])

    kind = dict(classes.dtypes)["vector"]
    return classes.select("size", "cid", "n", "vector").mapInArrow(
        run, f"table int, size int, key long, cid long, n long, vector {kind}"
    )


def cell_links(cells: DataFrame, cosine: float, tables: int, hashes: int, width: float, seed: int) -> DataFrame:
    """``cid, linked, root``: per cell and class, the vectors of other classes linked to it that no
    earlier table has brought together, and the smallest class joined to it in the cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers: dict[int, Hasher] = {}
        for cell in runs(batches, ["table", "size", "key", "low", "high"]):
            m = cell.num_rows
            if m < 2:
                continue
            unit = matrix(cell["vector"])
            cid, n, chunk = (cell[c].to_numpy() for c in ("cid", "n", "chunk"))
            t = cell["table"][0].as_py()
            across = cell["low"][0] != cell["high"][0]
            near = np.triu(unit @ unit.T >= cosine, 1)
            if across:
                near &= chunk[:, None] != chunk[None, :]
            a, b = np.nonzero(near)
            if not len(a):
                continue
            label = np.arange(m)
            join_labels(label, a, b)
            if t:  # a pair counts in the first table that has it
                members, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                hasher = hashers.setdefault(unit.shape[1], Hasher(unit.shape[1], tables, hashes, width, seed))
                keys = hasher.keys(unit[members])[:, :t]
                ka, kb = at[: len(a)], at[len(a) :]
                fresh = np.ones(len(a), bool)
                for earlier in range(t):
                    fresh &= keys[ka, earlier] != keys[kb, earlier]
                a, b = a[fresh], b[fresh]
            linked = np.bincount(a, n[b], m) + np.bincount(b, n[a], m)
            some = np.flatnonzero((linked > 0) | (label != np.arange(m)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[some]), pa.array(linked[some].astype(np.int64)), pa.array(cid[label[some]])],
                names=["cid", "linked", "root"],
            )

    return cells.mapInArrow(run, "cid long, linked long, root long")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Equal vectors are one class from the start; only classes are hashed and compared, so copies
    cost nothing more. A bucket of any size is compared in cells of bounded size, and links leave
    a cell as counts and stars, not as pairs. Vectors that are null, zero or not finite, and
    vectors of different lengths, link with nothing. Rows with equal ids are vectors of their
    own that may link; a null id never names a component unless it has no other.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    good = usable(F.col("vector"))
    valid, rest = rows.where(good), rows.where(~good)
    classes = valid.groupBy("vector").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = classes.withColumns({"size": F.size("vector"), "cid": F.monotonically_increasing_id()})
    classes = stage(classes, "vector-classes")
    members = stage(bucket_members(classes, tables, hashes, width, seed), "vector-buckets")
    shared = members.groupBy("table", "size", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    met = members.join(shared, ["table", "size", "key"], "left_semi").withColumn("spread", F.col("cid"))
    cells = dealt(met, ["table", "size", "key"], CHUNK)
    found = stage(cell_links(cells, cosine, tables, hashes, width, seed), "vector-links")
    stars = components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")), "vector-stars")
    counted = found.groupBy("cid").agg(F.sum("linked").alias("linked"))
    rooted = classes.select("cid", "least").join(stars.withColumnRenamed("node", "cid"), "cid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cid"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    described = (
        classes.select("vector", "cid", "n")
        .join(counted, "cid", "left")
        .join(rooted.select("cid", "root"), "cid")
        .join(names, "root")
        .select("vector", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    )
    linked = valid.join(described, "vector").select("vec_id", "n_links", "component_id")
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), good AS (
  SELECT vec_id, x FROM v
  WHERE x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(x, lambda e: e <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), named AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1
), counted AS (
  SELECT a AS vec_id, count(*) AS n FROM link GROUP BY 1
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM named LEFT JOIN counted USING (vec_id)
"""


@query("op1_embeddings", ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
