"""Exact top-k inner products by three phases with a uniform threshold.

Each vector is cut into ``PARTS`` parts, so that a score is the sum of as many local scores, each with a list of its own.
Phase 1 gathers the head of every local list and resolves what is on it; the k-th best exact score of a query is a
safe cutoff. Phase 2 sends each list the cutoff and collects every entry with at least its ``PARTS``-th part: a vector whose
local scores all lie below that cannot reach the cutoff, whatever their signs. Entries whose known local scores, with
the threshold for the unknown ones, stay below the cutoff are let go. Phase 3 resolves the remaining pairs exactly.

Queries and vectors are dealt by hash to a grid of cells of at most about ``CELL`` values a side, so that a task
holds two small matrices; a cell never sees more, however large the table.

Equal vectors have equal scores, so lists hold each distinct vector once, with its smallest ids: as many as can be among the
k best of a query, which is itself one of them. A group of copies is cut to those before the shuffle.

Components are ``floor(256 * x)``, held within a long's range, as are scores. Rows without an id, and vectors null or with a null or
non-finite component, take no part. Shorter vectors count as filled up with zeros; an empty one scores 0. Rows equal in id and
vector count once; of different vectors under one id the smallest counts. Ties go to the smaller id. A query with fewer
candidates lists them all; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketline.llm.batches import spread
from basketline.session import cut_lineage

K, EVERY, PARTS, CELL, SALTS = 5, 50, 2, 262_144, 8
EXACT = 2.0**53
LONGS = -(2**63), 2**63 - 1


def quantised(table: DataFrame) -> DataFrame:
    """(id, vec) of the rows that take part, one for each id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    rows = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    return rows.groupBy(F.col("vec_id").cast("long").alias("id")).agg(F.min(whole).alias("vec"))


def _distinct(rows: DataFrame, most: int) -> DataFrame:
    """(vid, vec, ids, asks): each distinct vector under its smallest id, with its ``most`` smallest ids."""
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= most)
    folded = few.groupBy("vec").agg(F.min("id").alias("vid"), F.sort_array(F.collect_list("id")).alias("ids"))
    return folded.select("vid", "vec", "ids")


def _cell(name: str, count: int):
    return F.pmod(F.xxhash64(F.col(name), F.lit(name)), F.lit(count)).cast("int")


class Grid:
    """Queries and vectors dealt to cells (g, s); pairs of their ids find the cell that holds both."""

    def __init__(self, n_queries: int, n_vectors: int, width: int):
        self.width = max(width, 1)
        side = max(1, CELL // self.width)
        self.g, self.s = max(1, math.ceil(n_queries / side)), max(1, math.ceil(n_vectors / side))

    def cells(self, queries: DataFrame, vectors: DataFrame) -> DataFrame:
        """Rows (g, s, asks, id, cutoff, vec): a query in every cell of its row, a vector in every one of its column."""
        q = queries.select(
            _cell("qid", self.g).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(self.s - 1))).alias("s"),
            F.lit(True).alias("asks"), F.col("qid").alias("id"), "cutoff", "vec",
        )
        v = vectors.select(
            F.explode(F.sequence(F.lit(0), F.lit(self.g - 1))).alias("g"), _cell("vid", self.s).alias("s"),
            F.lit(False).alias("asks"), F.col("vid").alias("id"), F.lit(None).cast("double").alias("cutoff"), "vec",
        )
        return q.unionByName(v)

    def parts(self, queries: DataFrame, vectors: DataFrame, parts: int):
        """The cells of each part of the vectors, grouped by part and cell."""
        step = math.ceil(self.width / parts)
        cells = self.cells(queries, vectors)
        part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        cut = cells.select("g", "s", "asks", "id", "cutoff", part.alias("part"), "vec")
        cut = cut.withColumn("vec", F.slice("vec", F.col("part") * step + 1, step))
        return cut.groupBy("g", "s", "part")

    def pairs(self, pairs: DataFrame):
        return pairs.select("qid", "vid", _cell("qid", self.g).alias("g"), _cell("vid", self.s).alias("s")).groupBy("g", "s")


def _matrix(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids in order, cutoffs and vectors, one in a row and filled up with zeros, as whole numbers."""
    column = table["vec"].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), spread(np.zeros(len(lengths), np.int64), lengths)] = values
    ids, cutoffs = table["id"].to_numpy(), table["cutoff"].to_numpy()
    order = np.argsort(ids, kind="stable")
    return ids[order], cutoffs[order], out[order]


def _sides(table: pa.Table, width: int):
    asks = table["asks"]
    return _matrix(table.filter(asks), width), _matrix(table.filter(pa.compute.invert(asks)), width)


def _largest(a: np.ndarray, b: np.ndarray) -> float:
    """A bound of all partial sums of products of a row of ``a`` with one of ``b``."""
    return float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * a.shape[1]


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, exact and held within a long's range."""
    if _largest(a, b) < EXACT:
        return np.einsum("ij,ij->i", a.astype(float), b.astype(float)).astype(np.int64)
    sums = [sum(x * y for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
    return np.array([min(max(s, LONGS[0]), LONGS[1]) for s in sums], np.int64)


def _chunks(n: int, size: int = 512):
    return ((i, min(i + size, n)) for i in range(0, n, size))


def _entries(qids, vids, local, slack=0.0) -> pa.Table:
    return pa.table({"qid": qids, "vid": vids, "local": local, "slack": np.full(len(qids), slack)})


def _heads(most: int, width: int):
    """Phase 1 in a cell: the ``most`` best entries of each query's local list."""

    def run(table: pa.Table) -> pa.Table:
        (qids, _, q), (vids, _, v) = _sides(table, width)
        found = [_entries(*[np.zeros(0, np.int64)] * 2, np.zeros(0))]
        n = min(most, len(vids))
        for a, b in _chunks(len(qids) if n else 0):
            local = q[a:b].astype(float) @ v.T.astype(float)
            top = np.argpartition(-local, n - 1, axis=1)[:, :n]
            found.append(_entries(np.repeat(qids[a:b], n), vids[top.ravel()], np.take_along_axis(local, top, 1).ravel()))
        out = pa.concat_tables(found)
        return out.append_column("part", pa.array(np.full(len(out), table["part"][0].as_py()), pa.int32()))

    return run


def _above(parts: int, width: int):
    """Phase 2 in a cell: every entry that reaches its part of the query's cutoff.

    ``slack`` is what rounding may take from a local score; whole numbers below 2**53 have none.
    """

    def run(table: pa.Table) -> pa.Table:
        (qids, cutoffs, q), (vids, _, v) = _sides(table, width)
        bound = _largest(q, v) if len(qids) and len(vids) else 0.0
        slack = 0.0 if bound < EXACT else 1e-9 * bound
        found = [_entries(*[np.zeros(0, np.int64)] * 2, np.zeros(0))]
        for a, b in _chunks(len(qids) if len(vids) else 0):
            local = q[a:b].astype(float) @ v.T.astype(float)
            rows, cols = np.nonzero(local >= (cutoffs[a:b] / parts - slack)[:, None])
            found.append(_entries(qids[a:b][rows], vids[cols], local[rows, cols], slack))
        return pa.concat_tables(found)

    return run


def _resolved(grid: Grid, queries: DataFrame, vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """(qid, vid, score) of every pair, computed where both vectors are."""
    width = grid.width

    def run(cell: pa.Table, wanted: pa.Table) -> pa.Table:
        (qids, _, q), (vids, _, v) = _sides(cell, width)
        asked, met = wanted["qid"].to_numpy(), wanted["vid"].to_numpy()
        i, j = np.searchsorted(qids, asked), np.searchsorted(vids, met)
        scores = [_dots(q[i[a:b]], v[j[a:b]]) for a, b in _chunks(len(asked), 65_536)]
        return pa.table({"qid": asked, "vid": met, "score": np.concatenate([np.zeros(0, np.int64), *scores])})

    cells = grid.cells(queries, vectors).groupBy("g", "s")
    return cells.cogroup(grid.pairs(pairs)).applyInArrow(run, "qid long, vid long, score long")


def _best(scores: DataFrame, by: str, most: int, id_column: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), id_column))
    return scores.withColumn("rank", place).filter(F.col("rank") <= most)


def nearest_vectors(queries: DataFrame, vectors: DataFrame, grid: Grid, most: int, parts: int = PARTS) -> DataFrame:
    """(qid, vid, score, rank): the ``most`` best of the distinct vectors (vid, vec) for each query (qid, vec)."""
    open_queries = queries.select("qid", "vec", F.lit(None).cast("double").alias("cutoff"))
    step = math.ceil(grid.width / parts)
    schema = "qid long, vid long, local double, slack double"
    heads = grid.parts(open_queries, vectors, parts).applyInArrow(_heads(most, step), f"{schema}, part int")
    place = F.row_number().over(Window.partitionBy("qid", "part").orderBy(F.desc("local"), "vid"))
    head_pairs = heads.withColumn("place", place).filter(F.col("place") <= most).select("qid", "vid").distinct()
    known = _resolved(grid, open_queries, vectors, head_pairs)
    cutoffs = _best(known, "qid", most, "vid").filter(F.col("rank") == most).select("qid", F.col("score").cast("double").alias("cutoff"))
    # a table of fewer vectors than are asked for has no cutoff: all its entries are collected
    bounded = queries.join(cutoffs, "qid", "left").select("qid", "vec", F.coalesce("cutoff", F.lit(-math.inf)).alias("cutoff"))
    bounded = cut_lineage(bounded)
    entries = grid.parts(bounded, vectors, parts).applyInArrow(_above(parts, step), schema)
    reach = F.sum("local") + F.count("*") * F.max("slack")
    sums = entries.groupBy("qid", "vid").agg(reach.alias("reach"), (parts - F.count("*")).alias("unknown"))
    left = sums.join(bounded.select("qid", "cutoff"), "qid").filter(
        (F.col("unknown") == 0) & (F.col("reach") >= F.col("cutoff"))
        | (F.col("unknown") > 0) & (F.col("reach") + F.col("unknown") * F.col("cutoff") / parts >= F.col("cutoff"))
    )
    return _best(_resolved(grid, bounded, vectors, left.select("qid", "vid")), "qid", most, "vid")


def top_k(table: DataFrame, k: int = K, every: int = EVERY, parts: int = PARTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose vec_id is divisible by ``every``."""
    rows = cut_lineage(quantised(table))
    asking = rows.filter(F.col("id") % every == 0)
    vectors = cut_lineage(_distinct(rows, k + 1))
    n_vectors, width = vectors.agg(F.count("*"), F.max(F.size("vec"))).first()
    queries = cut_lineage(asking.select("vec").distinct().join(vectors, "vec").select(F.col("vid").alias("qid"), "vec"))
    grid = Grid(queries.count(), n_vectors, width or 0)
    best = nearest_vectors(queries, vectors, grid, k + 1, parts)
    # from distinct vectors to their ids: a query's own id is one of the k + 1 best at most
    listed = best.join(vectors.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("vec_id"))
    listed = _best(listed, "qid", k + 1, "vec_id").groupBy("qid").agg(F.collect_list(F.struct("vec_id", "score")).alias("found"))
    answers = queries.join(listed, "qid").select("vec", "found", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = asking.select(F.col("id").alias("query_id"), "vec", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    told = own.join(answers, ["vec", "salt"]).select("query_id", F.explode("found").alias("hit"))
    told = told.filter(F.col("hit.vec_id") != F.col("query_id")).select("query_id", "hit.vec_id", "hit.score")
    return _best(told, "query_id", k, "vec_id").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
