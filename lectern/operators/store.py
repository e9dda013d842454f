"""K3/K4: keyed vector table with a dimension contract and upserts that touch only changed buckets.

A collection is a Parquet table partitioned by a hash bucket of the document key, next to a one-row
``contract`` table (dimension, distance, number of buckets) and the ``loads`` that have reserved ids.  An
upsert writes its points once, checks the contract while it writes them (an ``Observation``), then rewrites
the buckets of the changed keys by Spark's dynamic partition overwrite; files of other buckets stay as they
are.  Applying an upsert again gives the same table, so a job that died half-way is simply run again.
Single writer assumed; a reader that lists files during the overwrite may fail and has to read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern.functions.vectors import sq_norm
from lectern.operators.joins import broadcast_if_small
from lectern.session import hadoop_fs

KINDS = ["ok", "null_vector", "bad_dimension", "zero_norm"]
#: points of a bucket, about, and the least number of buckets
BUCKET_POINTS, LEAST_BUCKETS = 100_000, 32


def contract_kind(vec_col: str, dim: int):
    v = F.col(vec_col)
    return (F.when(v.isNull(), F.lit("null_vector"))
            .when(F.size(v) != dim, F.lit("bad_dimension"))
            .when(sq_norm(v) == 0, F.lit("zero_norm"))
            .otherwise(F.lit("ok")))


def contract_report(df: DataFrame, dim: int, id_col: str = "id", vec_col: str = "vector") -> DataFrame:
    """(kind, n_rows) for every kind, plus ``duplicate_id`` (rows whose id repeats)."""
    spark = df.sparkSession
    kinds = df.select(contract_kind(vec_col, dim).alias("kind")).groupBy("kind").agg(F.count("*").alias("n_rows"))
    dups = (df.groupBy(id_col).agg(F.count("*").alias("c")).filter(F.col("c") > 1)
            .agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows")).select(F.lit("duplicate_id").alias("kind"), "n_rows"))
    all_kinds = spark.createDataFrame([(k,) for k in KINDS], "kind string")
    filled = all_kinds.join(kinds, "kind", "left").select("kind", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    return filled.unionByName(dups).select("kind", F.col("n_rows").cast("long").alias("n_rows"))


class VectorStore:
    def __init__(self, spark: SparkSession, root: str, dim: int, key: str = "book_id",
                 id_col: str = "id", vec_col: str = "vector", buckets: int | None = None):
        self.spark, self.root, self.dim = spark, root.rstrip("/"), dim
        self.key, self.id_col, self.vec_col = key, id_col, vec_col
        self._buckets = buckets

    @property
    def points(self) -> str:
        return f"{self.root}/points"

    def _there(self, path: str) -> bool:
        fs, p = hadoop_fs(self.spark, path)
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        fs, p = hadoop_fs(self.spark, path)
        fs.delete(p, True)

    def exists(self) -> bool:
        return self._there(self.points)

    def buckets(self) -> int:
        """Buckets of the collection, as its contract says."""
        c = self.spark.read.parquet(f"{self.root}/contract").first()
        if c["dim"] != self.dim:
            raise ValueError(f"the collection has dimension {c['dim']}, not {self.dim}")
        return c["buckets"]

    def _table(self) -> DataFrame:
        return self.spark.read.parquet(self.points)

    def read(self) -> DataFrame:
        return self._table().drop("bucket")

    def next_id(self) -> int:
        """First id above all stored ones: where the ids of a further load start."""
        if not self.exists():
            return 0
        top = self.read().agg(F.max(self.id_col)).first()[0]
        return 0 if top is None else int(top) + 1

    def reserve(self, load: str) -> int:
        """First id of a named load (a micro-batch, say).  A load that comes again gets the id that it had."""
        path = f"{self.root}/loads"
        if self._there(path):
            had = self.spark.read.parquet(path).filter(F.col("load") == load).agg(F.min("first_id")).first()[0]
            if had is not None:
                return int(had)
        first = self.next_id()
        self.spark.createDataFrame([(load, first)], "load string, first_id long").coalesce(1).write.mode("append").parquet(path)
        return first

    def _bucket(self, n: int):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(n)).cast("int")

    def _checked(self, df: DataFrame, path: str):
        """Write ``df`` and check its contract on the way: kinds, rows and id range come with the write."""
        seen = Observation()
        kind = contract_kind(self.vec_col, self.dim)
        watched = df.observe(seen, F.count(F.lit(1)).alias("n"), F.count(F.when(kind != "ok", 1)).alias("bad"),
                             F.min(self.id_col).alias("lo"), F.max(self.id_col).alias("hi"))
        watched.write.mode("errorifexists").partitionBy("bucket").parquet(path)
        facts = seen.get
        written = self.spark.read.schema(df.schema).parquet(path)
        twice = facts["n"] and written.groupBy(self.id_col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
        if facts["bad"] or twice:
            self._refuse(path)
        return written, facts

    def _refuse(self, path: str):
        self._delete(path)
        raise ValueError(f"points violate the collection contract (dim={self.dim}, non-null, non-zero, unique ids)")

    def create_if_absent(self, points: DataFrame) -> None:
        """K3: the first load; later calls leave an existing collection untouched."""
        if self.exists():
            return
        staging = f"{self.root}/_staging-{uuid.uuid4().hex[:12]}"
        n = self._buckets or max(LEAST_BUCKETS, -(-points.select(self.key).count() // BUCKET_POINTS))
        self._checked(points.withColumn("bucket", self._bucket(n)).hint("rebalance", "bucket"), staging)
        self.spark.createDataFrame([(self.dim, "cosine", n)], "dim int, distance string, buckets int").coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.root}/contract")
        fs, src = hadoop_fs(self.spark, staging)
        if not fs.rename(src, hadoop_fs(self.spark, self.points)[1]):
            raise RuntimeError(f"could not create {self.points}")

    def upsert(self, points: DataFrame, replaced_keys: DataFrame | None = None) -> list[int]:
        """K4: rows of every replaced key are dropped, the new rows appended (last wins).  Returns the
        buckets that were rewritten.

        ``replaced_keys`` (one column named like ``key``) defaults to the keys present
        in ``points``; pass the delta's document keys so a document whose new version
        has no storable chunk also loses its old ones."""
        if not self.exists():
            self.create_if_absent(points)
            return []
        n = self.buckets()
        staging = f"{self.root}/_delta-{uuid.uuid4().hex[:12]}"
        old = self._table()
        new, facts = self._checked(points.select(*[c for c in old.columns if c != "bucket"]).withColumn("bucket", self._bucket(n)), staging)
        keys = (replaced_keys.select(self.key) if replaced_keys is not None else new.select(self.key)).distinct()
        keys = keys.withColumn("bucket", self._bucket(n))
        touched = sorted({r["bucket"] for r in keys.select("bucket").union(new.select("bucket")).distinct().collect()})  # buckets at most
        if not touched:
            self._delete(staging)
            return []
        held = old.filter(F.col("bucket").isin(touched))  # prunes to the files of these buckets
        kept = held.join(broadcast_if_small(keys.select(self.key)), self.key, "left_anti")
        if facts["n"] and facts["lo"] < self.next_id():
            # ids that could be taken: of rows that stay
            others = old.filter(~F.col("bucket").isin(touched)).select(self.id_col).union(kept.select(self.id_col))
            if others.join(new.select(self.id_col), self.id_col, "left_semi").limit(1).count():
                self._refuse(staging)
        out = kept.select(*old.columns).unionByName(new.select(*old.columns))
        left = {r["bucket"] for r in out.select("bucket").distinct().collect()}
        out.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("bucket").parquet(self.points)
        for b in set(touched) - left:
            self._delete(f"{self.points}/bucket={b}")  # all its rows have gone
        self._delete(staging)
        self.spark.catalog.refreshByPath(self.points)
        return touched
