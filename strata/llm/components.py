"""Connected components of links, by repeated contraction in DataFrames.

In each round every task first makes stars of the links it has, up to ``NODES`` nodes at a time: each node is linked with
the smallest one that these links reach. When all links were in one such chunk, that is the result; when the stars fit
one chunk, it is made of them. Else every node is merged into that neighbour (or itself) which comes first in an order
drawn anew for the round; links between merged nodes are renamed and made distinct. The number of links falls
geometrically, whatever the shape of the graph, and the rounds end once the rest fits a chunk: few links cost the driver
one or two tables. Each round is a written table, so lost executors cost at most a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship, tidied
from strata.session import written

NODES = 1 << 18  # some 50 MB in a task


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def _stars(most: int):
    """Links to rows (a, b, chunk): each node b of a chunk with the smallest a it reaches there, itself included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}
        chunk = TaskContext.get().partitionId() << 32

        def top(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        def stars() -> pa.RecordBatch:
            columns = [top(x) for x in up], list(up), [chunk] * len(up)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "chunk"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = top(a), top(b)
                up[max(a, b)] = min(a, b)
                if len(up) >= most:
                    yield stars()
                    up.clear()
                    chunk += 1
        if up:
            yield stars()

    return run


def components(links: DataFrame, most: int = NODES) -> DataFrame:
    """Links (a, b) to rows (node, component): the smallest node that is reachable; nodes without links are left out."""
    spark = links.sparkSession
    ship(spark)
    total: DataFrame | None = None
    step = 0
    links = _ordered(links)
    while True:
        step += 1
        stars = written(links.mapInArrow(tidied(_stars(most)), "a long, b long, chunk long"), "links")
        chunks = stars.agg(F.min("chunk").alias("first"), F.max("chunk").alias("last"), F.count("*").alias("n")).first()
        if chunks["first"] is None:
            break
        whole = chunks["first"] == chunks["last"]
        if not whole and chunks["n"] < most:
            links = stars.filter("a <> b").select("a", "b").coalesce(1)
            continue
        if whole:
            merged = stars.select(F.col("b").alias("node"), F.col("a").alias("into"))
            if total is None:
                return merged.withColumnRenamed("into", "component")
        else:
            links = stars.filter("a <> b").select("a", "b")
            both = links.union(links.select("b", "a"))
            rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(step)).alias("rank"), F.col(c).alias("node"))  # noqa: B023, E731
            merged = written(
                both.groupBy("a")
                .agg(F.min(rank("b")).alias("best"))
                .select(F.col("a").alias("node"), F.least(rank("a"), F.col("best"))["node"].alias("into")),
                "merged",
            )
            left, right = merged.toDF("a", "c"), merged.toDF("b", "d")
            links = _ordered(links.join(left, "a").join(right, "b").select(F.col("c").alias("a"), F.col("d").alias("b")))
        if total is None:
            total = merged
        else:
            further = merged.toDF("into", "next")
            total = written(
                total.join(further, "into", "left").select("node", F.coalesce("next", "into").alias("into")), "total"
            )
        if whole:
            break
    if total is None:
        return spark.createDataFrame([], "node long, component long")
    smallest = total.groupBy("into").agg(F.min("node").alias("component"))
    return written(total.join(smallest, "into").select("node", "component"), "components")
