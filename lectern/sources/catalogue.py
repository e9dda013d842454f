"""Catalogue JSON -- one JSON object per file holding a root array of entries.

Writing splits the catalogue into contiguous slices of bounded size (one object per
file, so no single task or file ever holds the whole catalogue); reading parses each
file as one document (``multiLine``) with an explicit schema and explodes the root
array.  Catalogue order (for first-match lookup) is (file name, position in the array).
"""

from __future__ import annotations

import math

import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.session import checkpoint_root

ENTRY_FIELDS = [("id", T.LongType()), ("title", T.StringType()), ("author", T.StringType()),
                ("context", T.StringType())]
MAX_ENTRIES_PER_FILE = 10_000


def entry_schema(with_context: bool = True) -> T.StructType:
    fields = ENTRY_FIELDS if with_context else ENTRY_FIELDS[:3]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def catalogue_schema(root_key: str, with_context: bool = True) -> T.StructType:
    return T.StructType([T.StructField(root_key, T.ArrayType(entry_schema(with_context)))])


def write_catalogue(entries: DataFrame, path: str, root_key: str, order_cols: list[str],
                    max_entries: int = MAX_ENTRIES_PER_FILE) -> int:
    """Entries -> ``{root_key: [...]}`` objects, one per file.  Returns the file count.

    Files are contiguous slices of the catalogue order: range partitioning on the order
    columns plus a unique tiebreaker, so even one id holding a third of all entries is
    spread over many files and no object exceeds about ``max_entries`` entries.  File
    names follow partition order, so (file name, array position) is the catalogue order.
    """
    checkpoint_root(entries.sparkSession)
    n = entries.count()
    nfiles = max(1, math.ceil(n / max_entries))
    fields = [c for c, _ in ENTRY_FIELDS if c in entries.columns]
    # the tiebreaker must not change when a lost task is recomputed: number the rows
    # of a reliably checkpointed (fixed) input
    keyed = entries.checkpoint(eager=True).withColumn("_u", F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(nfiles, *order_cols, "_u").sortWithinPartitions(*order_cols, "_u")

    def to_object(batches):
        import json
        items = []
        for pdf in batches:
            items.extend(pdf[fields].to_dict("records"))
        if items:
            for it in items:
                if "id" in it and it["id"] is not None:
                    it["id"] = int(it["id"])
            yield pd.DataFrame({"value": [json.dumps({root_key: items}, ensure_ascii=False)]})

    ranged.select(*fields).mapInPandas(to_object, "value string").write.mode("overwrite").text(path)
    return nfiles


def read_catalogue(spark: SparkSession, path: str, root_key: str, with_context: bool = True) -> DataFrame:
    """-> (id, title, author, [context], file, pos, part) one row per entry.  Catalogue order is
    (part, file, pos): part numbers count as numbers, so it holds beyond five digits."""
    raw = (spark.read.schema(catalogue_schema(root_key, with_context)).option("multiLine", True)
           .option("recursiveFileLookup", True).json(path))
    rows = raw.select(F.col("_metadata.file_name").alias("file"), F.posexplode(root_key).alias("pos", "e"))
    return rows.select("e.*", "file", "pos", F.regexp_extract("file", r"^part-(\d+)", 1).try_cast("long").alias("part"))
