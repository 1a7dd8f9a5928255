"""Approximate nearest neighbours by cosine: a neighbour graph from NN-descent, and greedy search on it.

First lists: vectors are hashed by the sides of random hyperplanes, in several
tables, and each vector is compared with the others of its buckets. Then
NN-descent: in every round a node's neighbours, and nodes that have it as a
neighbour, are joined to their vectors and compared with each other; the better ones
replace neighbours. Search: a query starts at its own node, and in every round
joins the best nodes it has not yet looked at to their neighbours, until its list of
best nodes no longer changes or ``SEARCH_ROUNDS`` are over. All rounds are Spark joins
between rows and blocks of nodes of bounded size; only the hyperplanes' offsets are
fitted on the driver, to a sample of ``SAMPLE`` vectors.

Rows with equal vectors are one node, so that copies do not fill the lists of
their neighbours; they come back as rows of their own in the result.

The graph works on unit vectors in single precision, multiplied in double precision. All nodes of a query's last list
are scored anew in double precision on the original vectors, so that near copies come in their true order.

Defined results: vectors that are null, empty or zero, hold null or non-finite
components, or have another length than most (the longer, if as many) take no
part, nor do rows with a null id; of rows with one id and one vector one counts; ties go to the smaller id; fewer
candidates than asked for are all returned; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored, uniform

NEIGHBOURS, TABLES, BUCKET, ROUNDS, SAMPLED = 20, 16, 800, 3, 12
BEAM, WIDTH, SEARCH_ROUNDS = 220, 110, 6
SAMPLE, SEED = 5000, 20240610
#: Nodes in a block, on average; a block is worked on in one call.
BLOCK = 256

LISTS = "block long, node long, neighbours array<long>, likeness array<double>"
FOUND = "block long, node long, other long, likeness double"


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~odd)
    rows = rows.where(F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (length["n"] if length else 0))


def _block(node: Column | str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), node), F.lit(blocks)).alias("block")


def _units(column: pa.ChunkedArray) -> np.ndarray:
    """Single-precision vectors from their bytes, as doubles: products of near copies differ in the last digits."""
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.float32).reshape(len(data), -1).astype(np.float64)


def in_range(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to [1/2, 1): exact, and squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))[1])


def best_lists(node: np.ndarray, other: np.ndarray, likeness: np.ndarray, most: int):
    """Rows of (node, other, likeness): each node's ``most`` best others, once each, best first."""
    order = np.lexsort((-likeness, other, node))
    node, other, likeness = node[order], other[order], likeness[order]
    once = np.ones(len(node), bool)
    once[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    node, other, likeness = node[once], other[once], likeness[once]
    order = np.lexsort((other, -likeness, node))
    node, other, likeness = node[order], other[order], likeness[order]
    first = np.searchsorted(node, node)
    kept = np.arange(len(node)) - first < most
    return node[kept], other[kept], likeness[kept]


def _as_lists(block: int, node: np.ndarray, other: np.ndarray, likeness: np.ndarray) -> pa.Table:
    nodes, starts = np.unique(node, return_index=True)
    offsets = pa.array(np.append(starts, len(node)), pa.int32())
    return pa.table(
        {
            "block": pa.array(np.full(len(nodes), block), pa.int64()),
            "node": pa.array(nodes, pa.int64()),
            "neighbours": pa.ListArray.from_arrays(offsets, pa.array(other, pa.int64())),
            "likeness": pa.ListArray.from_arrays(offsets, pa.array(likeness, pa.float64())),
        }
    )


def _flat(table: pa.Table, values: str) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of each element of a list column."""
    column = table[values].combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(sizes)), sizes), column.flatten().to_numpy(zero_copy_only=False)


class Graph:
    """A neighbour graph over the distinct vectors of a table."""

    def __init__(self, rows: DataFrame) -> None:
        """``rows`` has vec_id and vector, as of ``usable``."""
        spark = small_batches(rows.sparkSession)
        marked = rows.withColumn("a", F.xxhash64(F.lit(1), "vector")).withColumn("b", F.xxhash64(F.lit(2), "vector"))
        nodes = marked.groupBy("a", "b").agg(F.min("vec_id").alias("node"), F.first("vector").alias("vector"))

        def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.array(batch["vector"].to_pylist(), dtype=np.float64)
                if len(x):
                    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps huge and tiny components in range
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                unit = pa.array([v.tobytes() for v in x.astype(np.float32)], pa.binary())
                arrays = [batch[c] for c in ("node", "a", "b", "vector")] + [unit]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "a", "b", "vector", "unit"])

        self.nodes = stored(
            nodes.mapInArrow(shortened, "node long, a long, b long, vector array<double>, unit binary"), "ann-nodes"
        )
        self.rows, self.spark = marked, spark
        self.size = self.nodes.count()
        self.blocks = max(1, self.size // BLOCK)
        self.lists: DataFrame | None = None

    def first_lists(self) -> DataFrame:
        """Lists from the buckets of all tables."""
        sample = self.nodes.orderBy(uniform("node", seed=SEED)).limit(SAMPLE).select("unit").toPandas()["unit"]
        known = np.frombuffer(b"".join(sample), np.float32).reshape(len(sample), -1).astype(np.float64)
        bits = max(0, ceil(log2(max(1, self.size / BUCKET))))
        planes = np.random.default_rng(SEED).normal(size=(known.shape[1], TABLES * bits))
        offsets = np.median(known @ planes, axis=0) if bits else np.zeros(0)

        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sides = (_units(batch["unit"]) @ planes > offsets) if len(batch) else np.zeros((0, TABLES * bits), bool)
                codes = sides.reshape(len(sides), TABLES, bits) @ (1 << np.arange(bits, dtype=np.int64))
                for t in range(TABLES):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(codes), t), pa.int32()), pa.array(codes[:, t].astype(np.int64)), batch["node"], batch["unit"]],
                        names=["table", "code", "node", "unit"],
                    )

        dealt = self.nodes.select("node", "unit").mapInArrow(hashed, "table int, code long, node long, unit binary")
        # Buckets that are far too large are dealt to parts by hash, so that each is compared in bounded memory.
        counts = dealt.groupBy("table", "code", (F.col("code") % 3).alias("_")).agg(F.ceil(F.count("*") / (2 * BUCKET)).alias("parts"))
        counts = counts.select(F.col("table").alias("_table"), F.col("code").alias("_code"), "parts")
        dealt = dealt.join(counts, (F.col("table") == F.col("_table")) & (F.col("code") == F.col("_code")))
        part = F.pmod(F.xxhash64(F.lit(SEED + 1), "table", "node"), F.col("parts"))
        blocks = self.blocks

        def compared(table: pa.Table) -> pa.Table:
            node, units = table["node"].to_numpy(), _units(table["unit"])
            likeness = units @ units.T
            np.fill_diagonal(likeness, -9)
            most = min(NEIGHBOURS, len(node) - 1)
            if most < 1:
                return pa.table({"node": pa.array([], pa.int64()), "neighbours": pa.array([], pa.list_(pa.int64())), "likeness": pa.array([], pa.list_(pa.float64()))})
            best = np.argpartition(-likeness, most - 1, axis=1)[:, :most]
            offsets = pa.array(np.arange(0, len(node) * most + 1, most), pa.int32())
            return pa.table(
                {
                    "node": node,
                    "neighbours": pa.ListArray.from_arrays(offsets, pa.array(node[best].ravel())),
                    "likeness": pa.ListArray.from_arrays(offsets, pa.array(np.take_along_axis(likeness, best, 1).ravel())),
                }
            )

        found = dealt.select("table", "code", part.alias("part"), "node", "unit").groupBy("table", "code", "part").applyInArrow(
            compared, "node long, neighbours array<long>, likeness array<double>"
        )

        def merged(key: tuple, table: pa.Table) -> pa.Table:
            row, other = _flat(table, "neighbours")
            _, likeness = _flat(table, "likeness")
            return _as_lists(key[0].as_py(), *best_lists(table["node"].to_numpy()[row], other, likeness, NEIGHBOURS))

        return found.select(_block("node", blocks), "*").groupBy("block").applyInArrow(merged, LISTS)

    def descend(self, lists: DataFrame, turn: int) -> DataFrame:
        """Lists improved by the neighbours of neighbours."""
        edges = lists.select("node", F.explode("neighbours").alias("other"))
        edges = edges.withColumn("luck", F.xxhash64(F.lit(SEED + turn), "node", "other"))

        def some(centre: str, member: str) -> DataFrame:
            """A random part of the edges, at most ``SAMPLED`` of a centre, as NN-descent has it."""
            rank = F.row_number().over(Window.partitionBy(centre).orderBy("luck"))
            rows = edges.withColumn("rank", rank).where(F.col("rank") <= SAMPLED)
            return rows.select(F.col(centre).alias("centre"), F.col(member).alias("member"))

        members = some("node", "other").unionByName(some("other", "node")).distinct()
        last = lists.select(F.col("node").alias("_node"), F.when(F.size("likeness") >= NEIGHBOURS, F.element_at("likeness", -1)).otherwise(-9.0).cast("double").alias("least"))
        info = self.nodes.select("node", "unit").join(last, F.col("node") == F.col("_node"), "left").drop("_node")
        info = stored(info.withColumn("least", F.coalesce("least", F.lit(-9.0).cast("double"))), "ann-info")
        local = members.join(info, F.col("member") == F.col("node")).select(
            _block("centre", self.blocks), "centre", "member", "unit", "least"
        )

        def compared(table: pa.Table) -> pa.Table:
            order = np.argsort(table["centre"].to_numpy(), kind="stable")
            centre, member = table["centre"].to_numpy()[order], table["member"].to_numpy()[order]
            units, least = _units(table["unit"])[order], table["least"].to_numpy()[order]
            bounds = np.append(np.unique(centre, return_index=True)[1], len(centre))
            out: list[tuple] = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                likeness = units[a:b] @ units[a:b].T
                np.fill_diagonal(likeness, -9)
                one, two = np.nonzero(likeness > least[a:b, None])
                out.append((member[a + one], member[a + two], likeness[one, two]))
            node, other, likeness = (np.concatenate(x) for x in zip(*out, strict=True))
            node, other, likeness = best_lists(node, other, likeness, NEIGHBOURS)
            return pa.table({"node": node, "other": other, "likeness": likeness})

        found = local.groupBy("block").applyInArrow(compared, "node long, other long, likeness double")
        found = found.select(_block("node", self.blocks), "*")

        def merged(key: tuple, old: pa.Table, new: pa.Table) -> pa.Table:
            row, other = _flat(old, "neighbours")
            _, likeness = _flat(old, "likeness")
            node = np.concatenate([old["node"].to_numpy()[row], new["node"].to_numpy()])
            other = np.concatenate([other, new["other"].to_numpy()])
            likeness = np.concatenate([likeness, new["likeness"].to_numpy()])
            return _as_lists(key[0].as_py(), *best_lists(node, other, likeness, NEIGHBOURS))

        return lists.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(merged, LISTS)

    def build(self, rounds: int = ROUNDS) -> Graph:
        lists = stored(self.first_lists(), "ann-lists") if self.size > 1 else self.spark.createDataFrame([], LISTS)
        for turn in range(rounds if self.size > BUCKET else 0):
            lists = stored(self.descend(lists, turn), "ann-lists")
        self.lists = lists
        return self

    def adjacency(self) -> DataFrame:
        """One row per edge, both ways, with the vector of its end: block and node, other, unit."""
        edges = self.lists.select("node", F.explode(F.arrays_zip("neighbours", "likeness")).alias("e"))
        edges = edges.select("node", F.col("e.neighbours").alias("other"), F.col("e.likeness").alias("likeness"))
        # A hub keeps its nearest followers: the others reach it, and it reaches them through these.
        near = F.row_number().over(Window.partitionBy("other").orderBy(F.desc("likeness"), "node"))
        back = edges.withColumn("rank", near).where(F.col("rank") <= 2 * NEIGHBOURS)
        both = edges.select("node", "other").unionByName(
            back.select(F.col("other").alias("node"), F.col("node").alias("other"))
        ).distinct()
        ends = self.nodes.select(F.col("node").alias("_node"), "unit")
        joined = both.join(ends, F.col("other") == F.col("_node")).select(_block("node", self.blocks), "node", "other", "unit")

        def gathered(key: tuple, table: pa.Table) -> pa.Table:
            order = np.argsort(table["node"].to_numpy(), kind="stable")
            return pa.table(
                {
                    "block": key[0].cast(pa.int64()).as_py() * np.ones(1, np.int64),
                    "nodes": [table["node"].to_numpy()[order].tobytes()],
                    "others": [table["other"].to_numpy()[order].tobytes()],
                    "units": [b"".join([table["unit"][int(k)].as_py() for k in order])],
                }
            )

        return joined.groupBy("block").applyInArrow(gathered, "block long, nodes binary, others binary, units binary")

    def search(self, queries: DataFrame, beam: int = BEAM, width: int = WIDTH, rounds: int = SEARCH_ROUNDS) -> DataFrame:
        """query and its list of best nodes (``others``, best first). ``queries`` has query, entry (a node) and unit."""
        asked = max(1, queries.count() // 16)  # groups of queries
        edges = stored(self.adjacency(), "ann-edges")

        def group(column: str) -> Column:
            return F.pmod(F.xxhash64(F.lit(SEED + 2), column), F.lit(asked)).alias("group")

        state = queries.select(
            group("query"), "query", "unit", F.array("entry").alias("others"), F.array(F.lit(2.0).cast("double")).alias("likeness"),
            F.array(F.lit(True)).alias("open"),
        )
        kind = "group long, query long, unit binary, others array<long>, likeness array<double>, open array<boolean>"
        state = stored(state.select(*[F.col(c) for c in state.columns]), "ann-state")

        def expanded(front: pa.Table, known: pa.Table) -> pa.Table:
            if not front.num_rows or not known.num_rows:
                return pa.table({"query": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "likeness": pa.array([], pa.float64())})
            nodes = np.frombuffer(known["nodes"][0].as_py(), np.int64)
            others = np.frombuffer(known["others"][0].as_py(), np.int64)
            units = np.frombuffer(known["units"][0].as_py(), np.float32).reshape(len(nodes), -1).astype(np.float64)
            at = front["node"].to_numpy()
            a, b = np.searchsorted(nodes, at), np.searchsorted(nodes, at, side="right")
            own, query, least = _units(front["unit"]), front["query"].to_numpy(), front["least"].to_numpy()
            out: list[tuple] = []
            for k in range(len(at)):
                likeness = units[a[k] : b[k]] @ own[k]
                good = np.flatnonzero(likeness > least[k])
                out.append((np.full(len(good), query[k]), others[a[k] + good], likeness[good]))
            query, other, likeness = (np.concatenate(x) for x in zip(*out, strict=True))
            query, other, likeness = best_lists(query, other, likeness, beam)
            return pa.table({"query": query.astype(np.int64), "other": other, "likeness": likeness})

        def merged(state: pa.Table, found: pa.Table) -> pa.Table:
            found_query = found["query"].to_numpy()
            order = np.argsort(found_query, kind="stable")
            found_query, other = found_query[order], found["other"].to_numpy()[order]
            likeness = found["likeness"].to_numpy()[order]
            out = []
            for row in state.to_pylist():
                a, b = np.searchsorted(found_query, row["query"]), np.searchsorted(found_query, row["query"], side="right")
                open_places = np.flatnonzero(row["open"])[:width]
                still = np.array(row["open"], dtype=bool)
                still[open_places] = False
                held = set(row["others"])
                fresh = np.array([o not in held for o in other[a:b].tolist()], dtype=bool)
                ids = np.concatenate([np.array(row["others"], np.int64), other[a:b][fresh]])
                scores = np.concatenate([np.array(row["likeness"], np.float64), likeness[a:b][fresh]])
                still = np.concatenate([still, np.ones(int(fresh.sum()), bool)])
                ids, at = np.unique(ids, return_index=True)
                scores, still = scores[at], still[at]
                best = np.lexsort((ids, -scores))[:beam]
                out.append(row | {"others": ids[best].tolist(), "likeness": scores[best].tolist(), "open": still[best].tolist()})
            schema = pa.schema([("group", pa.int64()), ("query", pa.int64()), ("unit", pa.binary()), ("others", pa.list_(pa.int64())), ("likeness", pa.list_(pa.float64())), ("open", pa.list_(pa.bool_()))])
            return pa.Table.from_pylist(out, schema)

        for _ in range(rounds):
            looked = F.slice(F.filter("others", lambda o, i: F.element_at("open", i + 1)), 1, width)
            least = F.when(F.size("others") >= beam, F.element_at("likeness", -1)).otherwise(F.lit(-9.0)).cast("double")
            front = state.select("query", "unit", least.alias("least"), F.explode(looked).alias("node"))
            front = front.select(_block("node", self.blocks), "*")
            found = front.groupBy("block").cogroup(edges.groupBy("block")).applyInArrow(
                expanded, "query long, other long, likeness double"
            )
            found = found.select(group("query"), "*")
            state = stored(state.groupBy("group").cogroup(found.groupBy("group")).applyInArrow(merged, kind), "ann-state")
            if not state.where(F.exists("open", lambda o: o)).head(1):
                break
        return state.select("query", "others")

    def nearest(self, is_query: Column, k: int = 5) -> DataFrame:
        """query_id, rank, vec_id and score of the ``k`` nearest other rows of each query row.

        ``is_query`` is a condition on vec_id.
        """
        node_of = self.nodes.select("node", F.col("a").alias("_a"), F.col("b").alias("_b"))
        ids = self.rows.select("vec_id", "a", "b").distinct()
        placed = ids.join(node_of, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).select("vec_id", "node")
        placed = stored(placed, "ann-placed")
        asked = placed.where(is_query).withColumnRenamed("vec_id", "query_id")
        own = self.nodes.select("node", "unit", "vector")
        queries = stored(asked.select("node").distinct().join(own, "node"), "ann-queries")
        found = self.search(queries.select(F.col("node").alias("query"), F.col("node").alias("entry"), "unit"))
        pairs = found.select("query", F.explode(F.array_union(F.array("query"), "others")).alias("other"))
        one = self.nodes.select(F.col("node").alias("_one"), F.col("vector").alias("x"))
        two = self.nodes.select(F.col("node").alias("_two"), F.col("vector").alias("y"))
        pairs = pairs.join(one, F.col("query") == F.col("_one")).join(two, F.col("other") == F.col("_two"))

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                x, y = (in_range(np.array(batch[c].to_pylist(), dtype=np.float64).reshape(len(batch), -1)) for c in ("x", "y"))
                score = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
                yield pa.RecordBatch.from_arrays([batch["query"], batch["other"], pa.array(score)], names=["query", "other", "score"])

        scored = stored(
            pairs.select("query", "other", "x", "y").mapInArrow(exact, "query long, other long, score double"), "ann-scored"
        )
        # More than k + 1 rows of one vector cannot be among the k nearest: smaller ids come first.
        smallest = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
        copies = placed.withColumn("copy", smallest).where(F.col("copy") <= k + 1).select(F.col("node").alias("_node"), "vec_id")
        rows = asked.join(scored, F.col("node") == F.col("query")).join(copies, F.col("other") == F.col("_node"))
        rows = rows.where("vec_id <> query_id")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest other rows of each row for which ``is_query`` (a condition on vec_id) holds."""
    graph = Graph(usable(vectors, id_column, vector_column))
    return graph.build().nearest(is_query, k)
