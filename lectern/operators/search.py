"""Top-k similarity search of questions against a vector table.

No nested-loop join.  The question side is size-checked and broadcast as one numpy
matrix; beyond the bound it is searched block by block, each block's hits written before the next
one is read, so the driver holds one block.  Every partition of the vector
table scores its rows with one matmul per Arrow batch and keeps a running per-question
top-k under the total order (score desc, id asc).  Of a table of many partitions one of
``FIRST_SHARE`` points is searched first: the k-th score found there is one that no hit falls below,
and only rows that reach it leave a task, so the rows that are shuffled do not grow with the number
of partitions.  Vector rows never move.

Cell search (V4) keeps the points in folders by cell and scores a point only with the questions
that probe its cell; grouped search scores it only with the questions of its group.

Scores are rounded to ``SCORE_DIGITS`` before ranking so that exact duplicates tie
deterministically (ties broken by the lower id).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.session import scratch_dir, small_batches

SCORE_DIGITS = 9
MAX_BROADCAST_BYTES = 256 << 20

CAND_SCHEMA = T.StructType([
    T.StructField("qid", T.LongType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("score", T.DoubleType(), False),
])


#: points looked at first in a table of more than twice as many partitions: one of so many
FIRST_SHARE = 64
SCORE_CELLS = 2_000_000  # scores held at once per task (rows x questions), ~16 MB


def _select_topk(S: np.ndarray, I: np.ndarray, k: int):
    """Exact top-k per column under (score desc, id asc).

    ``argpartition`` keeps 2k candidates per column in linear time; a column is
    re-sorted in full only when ties at the cut could reach past the kept candidates."""
    n = S.shape[0]
    if n <= 2 * k:
        order = np.lexsort((I, -S), axis=0)[:k]
        return np.take_along_axis(S, order, 0), np.take_along_axis(I, order, 0)
    m = 2 * k
    part = np.argpartition(-S, m - 1, axis=0)[:m]
    Ss, Is = np.take_along_axis(S, part, 0), np.take_along_axis(I, part, 0)
    kth = -np.partition(-Ss, k - 1, axis=0)[k - 1]
    unsafe = np.flatnonzero(Ss.min(axis=0) >= kth)  # a tie at the k-th score may continue
    if unsafe.size:
        full = np.lexsort((I[:, unsafe], -S[:, unsafe]), axis=0)[:m]
        Ss[:, unsafe] = np.take_along_axis(S[:, unsafe], full, 0)
        Is[:, unsafe] = np.take_along_axis(I[:, unsafe], full, 0)
    order = np.lexsort((Is, -Ss), axis=0)[:k]
    return np.take_along_axis(Ss, order, 0), np.take_along_axis(Is, order, 0)


def _partial_topk(bc, k: int, id_col: str, vec_col: str, cell_col: str | None, group_col: str | None = None):
    def fn(batches):
        payload = bc.value
        qids, Q = payload["qids"], payload["Q"]
        probe = payload.get("probe")  # (nq, ncells) bool, only for cell-restricted search
        qgroups = payload.get("groups")  # (nq,) question group, only for grouped search
        nq = len(qids)
        best_s = np.full((k, nq), -np.inf)
        best_i = np.full((k, nq), np.iinfo(np.int64).max)

        def merge(ids, V, qs):
            """Score these rows with these questions and keep their best."""
            step = max(16, SCORE_CELLS // max(1, len(ids)))  # questions scored together
            for lo in range(0, len(qs), step):
                part = qs[lo:lo + step]
                S = np.round(V @ Q[part].T, SCORE_DIGITS)
                S, I = _select_topk(np.vstack([best_s[:, part], S]), np.vstack([best_i[:, part], np.broadcast_to(ids[:, None], S.shape)]), k)
                best_s[:, part], best_i[:, part] = S, I

        every = np.arange(nq)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            ids = pdf[id_col].to_numpy(dtype=np.int64)
            V = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec_col]])
            if probe is None and qgroups is None:
                merge(ids, V, every)
                continue
            # rows of one cell (of a file: all of them) or group, with their questions only
            of = pdf[cell_col if probe is not None else group_col].to_numpy(dtype=np.int64)
            for x in np.unique(of):
                qs = np.flatnonzero(probe[:, x]) if probe is not None else np.flatnonzero(qgroups == x)
                if len(qs):
                    merge(ids[of == x], V[of == x], qs)
        keep = np.isfinite(best_s)
        if "least" in payload:
            keep &= best_s >= payload["least"]
        r, c = np.nonzero(keep)
        if not len(r):
            return
        out = {"qid": qids[c].astype(np.int64), "id": best_i[r, c], "score": best_s[r, c]}
        if qgroups is not None:
            out["grp"] = qgroups[c].astype(np.int64)
        yield pd.DataFrame(out)
    return fn


def _question_blocks(questions: DataFrame, max_bytes: int, dim_hint: int | None = None):
    """Size check of the question side: (n, dim, number of blocks).

    With the dimension known, counting rows is enough (the vector column is pruned,
    so an embedding UDF is not evaluated for the check)."""
    if dim_hint:
        n, dim = questions.select("qid").count(), dim_hint
    else:
        stats = questions.agg(F.count("*").alias("n"), F.max(F.size("qvec")).alias("dim")).first()
        n, dim = int(stats["n"] or 0), int(stats["dim"] or 0)
    nbytes = n * max(dim, 1) * 8
    return n, dim, max(1, math.ceil(nbytes / max_bytes))


def _ranked(cand: DataFrame, k: int) -> DataFrame:
    grp = ["grp"] if "grp" in cand.columns else []
    w = Window.partitionBy("qid", *grp).orderBy(F.col("score").desc(), F.col("id").asc())
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(points: DataFrame, questions: DataFrame, k: int = 4, id_col: str = "id",
          vec_col: str = "vector", qid_col: str = "qid", qvec_col: str = "qvec",
          max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
          cells: dict | None = None, group_col: str | None = None, dim_hint: int | None = None,
          first_share: int | None = None) -> DataFrame:
    """Exact top-k per question -> (qid, rank, id, score).

    ``cells`` (from ``ann_index`` or ``cell_index``) restricts each question to the points of its
    probed cells (approximate search); ``points`` must then carry ``cell``.
    ``group_col`` (an integer column on both sides) restricts each question row to the
    points of its own group -- several collections searched in one job; the output
    then carries the group column and ranks per (qid, group).
    ``first_share``: look at one of so many points first, for a threshold (default: ``FIRST_SHARE``
    where the table has more than twice as many partitions).
    """
    spark = points.sparkSession
    small_batches(spark)
    qcols = [F.col(qid_col).cast("long").alias("qid"), F.col(qvec_col).cast("array<double>").alias("qvec")]
    if group_col:
        qcols.append(F.col(group_col).cast("long").alias("grp"))
    q = questions.select(*qcols).filter(F.col("qvec").isNotNull())
    n, _dim, nblocks = _question_blocks(questions.select(F.col(qid_col).alias("qid")) if dim_hint else q,
                                        max_broadcast_bytes, dim_hint)
    cell_col = "cell" if cells is not None else None
    cols = [F.col(id_col).cast("long").alias(id_col), F.col(vec_col).alias(vec_col)]
    if cell_col:
        cols.append(F.col(cell_col))
    if group_col:
        cols.append(F.col(group_col))
    pts = points.filter(F.col(vec_col).isNotNull()).select(*cols)
    if first_share is None and n > 0:
        first_share = FIRST_SHARE if pts.rdd.getNumPartitions() > 2 * FIRST_SHARE else 1
    schema = CAND_SCHEMA if not group_col else T.StructType(CAND_SCHEMA.fields + [T.StructField("grp", T.LongType(), False)])
    gsel = [F.col("grp").alias(group_col)] if group_col else []
    done = None
    if nblocks > 1:
        # blocks are read from files, one at a time
        at = scratch_dir(spark, "questions")
        q.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(nblocks))).write.partitionBy("block").parquet(at)
        stored = spark.read.parquet(at)
    for b in range(nblocks if n > 0 else 0):
        pdf = (q if nblocks == 1 else stored.filter(F.col("block") == b)).toPandas()  # at most max_broadcast_bytes of vectors
        if len(pdf) == 0:
            continue
        payload = {"qids": pdf["qid"].to_numpy(dtype=np.int64),
                   "Q": np.stack([np.asarray(v, dtype=np.float64) for v in pdf["qvec"]])}
        block_pts = pts
        if cells is not None:
            payload["probe"] = _probe_matrix(payload["Q"], cells["centers"], cells["nprobe"])
            # only probed cells are read (file pruning when the table is stored by cell)
            probed = [int(c) for c in np.flatnonzero(payload["probe"].any(axis=0))]
            block_pts = pts.filter(F.col(cell_col).isin(probed))
        if group_col:
            payload["groups"] = pdf["grp"].to_numpy(dtype=np.int64)

        def search(rows: DataFrame, bc) -> DataFrame:
            return _ranked(rows.mapInPandas(_partial_topk(bc, k, id_col, vec_col, cell_col, group_col), schema), k)

        if first_share > 1:
            # the k-th score among some of the points: no hit falls below it
            bc = spark.sparkContext.broadcast(payload)
            some = block_pts.filter(F.pmod(F.xxhash64(id_col), F.lit(first_share)) == 0)
            found = search(some, bc).filter(F.col("rank") == k).toPandas()  # a row a question
            bc.unpersist()
            key = ["qid", "grp"] if group_col else ["qid"]
            known = pdf[key].merge(found, on=key, how="left")["score"]
            payload["least"] = known.fillna(-np.inf).to_numpy()
        bc = spark.sparkContext.broadcast(payload)
        hits = search(block_pts, bc)
        if nblocks > 1:
            path = scratch_dir(spark, "hits")
            hits.write.parquet(path)
            bc.unpersist()
            hits = spark.read.schema(hits.schema).parquet(path)
        done = hits if done is None else done.unionByName(hits)
    if done is None:
        extra = f", {group_col} long" if group_col else ""
        return spark.createDataFrame([], f"qid long{extra}, rank int, id long, score double")
    return done.select("qid", *gsel, F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


# ---------------------------------------------------------------- approximate (V4)

def _probe_matrix(Q: np.ndarray, centers: np.ndarray, nprobe: int) -> np.ndarray:
    cn = centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-300)
    qn = Q / np.maximum(np.linalg.norm(Q, axis=1, keepdims=True), 1e-300)
    sims = np.round(qn @ cn.T, SCORE_DIGITS)
    top = np.argsort(-sims, axis=1, kind="stable")[:, :nprobe]
    probe = np.zeros((Q.shape[0], centers.shape[0]), dtype=bool)
    np.put_along_axis(probe, top, True, axis=1)
    return probe


def ann_index(points: DataFrame, vec_col: str = "vector", n_cells: int = 16, nprobe: int = 2,
              seed: int = 7, max_iter: int = 20):
    """KMeans (cosine) cells over the vector table -> (points with ``cell``, cell info).

    The centres are n_cells x dim numbers (a parameter, not data size), so handing
    them to every task is bounded.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    feats = points.filter(F.col(vec_col).isNotNull()).withColumn("_features", array_to_vector(F.col(vec_col)))
    model = KMeans(k=n_cells, seed=seed, maxIter=max_iter, featuresCol="_features",
                   predictionCol="cell", distanceMeasure="cosine").fit(feats)
    centers = np.stack([np.asarray(c, dtype=np.float64) for c in model.clusterCenters()])
    assigned = model.transform(feats).drop("_features")
    return assigned, {"centers": centers, "nprobe": nprobe}


def _unit(a: np.ndarray) -> np.ndarray:
    return a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)


def assign_cells(points: DataFrame, centers: np.ndarray, vec_col: str = "vector") -> DataFrame:
    """``points`` with ``cell``: the centre of the greatest cosine, the first of equals."""
    bc = points.sparkSession.sparkContext.broadcast(_unit(centers))

    def assign(batches):
        for pdf in batches:
            V = _unit(np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec_col]])) if len(pdf) else np.zeros((0, 1))
            yield pdf.assign(cell=np.round(V @ bc.value.T, SCORE_DIGITS).argmax(axis=1).astype(np.int32) if len(pdf) else [])
    schema = T.StructType(points.schema.fields + [T.StructField("cell", T.IntegerType(), False)])
    return points.filter(F.col(vec_col).isNotNull()).mapInPandas(assign, schema)


def _cell_sums(assigned: DataFrame, vec_col: str, n_cells: int) -> np.ndarray:
    """Sum of the unit vectors of each cell: a task hands on one row a cell at most."""
    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            if len(pdf):
                V = _unit(np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec_col]]))
                for c in pdf["cell"].unique():
                    total[int(c)] = total.get(int(c), 0) + V[(pdf["cell"] == c).to_numpy()].sum(axis=0)
        if total:
            yield pd.DataFrame({"cell": list(total), "v": [v.tolist() for v in total.values()]})
    part = assigned.select("cell", vec_col).mapInPandas(sums, "cell int, v array<double>")
    rows = (part.select("cell", F.posexplode("v").alias("pos", "x")).groupBy("cell", "pos").agg(F.sum("x").alias("x"))
            .groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v")).collect())
    out = np.zeros((n_cells, len(rows[0]["v"]) if rows else 0))
    for r in rows:
        out[r["cell"]] = [e["x"] for e in r["v"]]
    return out


def cell_index(points: DataFrame, path: str, n_cells: int = 256, nprobe: int = 90, rounds: int = 1,
               id_col: str = "id", vec_col: str = "vector"):
    """V4 as inverted cells: (points stored in a folder per cell, cell info).

    The centres are the points of the least md5 of their id, moved ``rounds`` times to the mean
    direction of their cell.  They are n_cells x dim numbers, a parameter, which the driver holds."""
    pts = points.filter(F.col(vec_col).isNotNull())
    first = pts.orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(n_cells).select(vec_col).collect()
    centers = _unit(np.array([r[0] for r in first], dtype=np.float64)) if first else np.zeros((0, 1))
    assigned = pts
    if len(centers):
        for _ in range(rounds):
            sums = _cell_sums(assign_cells(pts, centers, vec_col), vec_col, len(centers))
            centers = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, sums, centers)
        assigned = assign_cells(pts, centers, vec_col)
    else:
        assigned = pts.withColumn("cell", F.lit(0))
    assigned.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)
    schema = T.StructType([f for f in assigned.schema.fields if f.name != "cell"] + [T.StructField("cell", T.IntegerType())])
    return points.sparkSession.read.schema(schema).parquet(path), {"centers": centers, "nprobe": nprobe}


def probed_cells(questions: DataFrame, cells: dict, qid_col: str = "qid", qvec_col: str = "qvec") -> DataFrame:
    """(qid, cell) of the cells that each question probes."""
    bc = questions.sparkSession.sparkContext.broadcast(cells)

    def probes(batches):
        c = bc.value
        for pdf in batches:
            if len(pdf):
                q, cell = np.nonzero(_probe_matrix(np.stack([np.asarray(v, np.float64) for v in pdf["qvec"]]), c["centers"], c["nprobe"]))
                yield pd.DataFrame({"qid": pdf["qid"].to_numpy()[q], "cell": cell.astype(np.int32)})
    rows = questions.select(F.col(qid_col).cast("long").alias("qid"), F.col(qvec_col).alias("qvec")).filter("qvec is not null")
    return rows.mapInPandas(probes, "qid long, cell int")
