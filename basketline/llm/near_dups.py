"""Near duplicates by improved consistent weighted sampling of TF-IDF shingles.

Texts with equal words are one node. Its shingles are runs of ``SHINGLE`` words (a shorter text is one shingle), weighed by
count times a smoothed idf between 1 and 2. Document frequencies cover all documents and are kept by hash bucket:
``DF_BUCKETS`` numbers, whatever the data, so that table may be broadcast. ``BANDS`` x ``ROWS`` samples are
banded. In a band key every node is first a candidate with the key's smallest and largest node; candidates are verified by exact
weighted Jaccard similarity of the whole texts, ``LEAST`` or more, and verified links joined into classes. Where a key still
holds more than one class, every pair of its nodes from different classes is a candidate too, so that no link between
classes is lost, while a large group of near copies is not paired out. These pairs are never rows: the key's nodes are cut into
blocks of about ``CELL``, a cell holds two blocks, and a task compares a cell's texts by products of matrices. So a key of n nodes
moves about n * n / ``CELL`` rows; the comparisons are still those of all pairs across classes, as the exact answer needs.

A null text has no words; texts without words are a class each by themselves. Ties go to the smallest doc_id.
Repeated rows share a class. An empty table gives an empty result. Other columns are packed while they pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline.llm.groups import components
from basketline.llm.tables import GAP, text_of, unpacked, whole_row
from basketline.session import cut_lineage

SHINGLE, LEAST, BANDS, ROWS, DF_BUCKETS, SEED = 5, 0.8, 14, 4, 2**18, 11
#: Shingles that are sampled at once.
BLOCK = 4096
#: Texts in a block of a cell, and shingles that a cell's matrices hold at once.
CELL, WIDTH = 128, 4096
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def hashed(text: Column) -> Column:
    """Hashes of the words of a text; an empty one has none."""
    each = F.transform(F.split(text, " "), lambda w: F.xxhash64(w))
    return F.when(text == "", F.array().cast("array<long>")).otherwise(each)


def counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of a text, given as hashes of its words, and their counts."""
    if not len(h):
        return h, np.zeros(0, np.int64)
    width = min(SHINGLE, len(h))
    out = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        out = _mixed(out * MIX + h[i : i + len(out)])
    return np.unique(out, return_counts=True)


def shingles(words: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``counted`` of each text of a batch."""
    hashes, at = words.values.to_numpy(zero_copy_only=False).view(np.uint64), words.offsets.to_numpy()
    for start, end in zip(at[:-1], at[1:], strict=True):
        yield counted(hashes[start:end])


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h % np.uint64(DF_BUCKETS)).astype(np.int64)


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """Smoothed idf by bucket, from counts over all rows of (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs = np.zeros(DF_BUCKETS, np.int64), 0
        for batch in batches:
            for h, _ in shingles(batch["words"]):
                at = _bucket(h)
                seen += np.bincount(at, minlength=DF_BUCKETS) if len(at) > 20_000 else 0
                if len(at) <= 20_000:
                    np.add.at(seen, at, 1)
                docs += 1
        pa.default_memory_pool().release_unused()
        at = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], docs))], names=["bucket", "n"])

    table = rows.select(hashed(F.col("text")).alias("words")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(DF_BUCKETS)
    total = float(table.n[table.bucket < 0].sum())
    inner = table[table.bucket >= 0]
    seen[inner.bucket.to_numpy()] = np.minimum(inner.n.to_numpy(), total)
    return (1 + np.log((total + 1) / (seen + 1)) / np.log(total + 2)).astype(np.float32)


def _draws() -> tuple[np.ndarray, ...]:
    """1 / r, beta, r and log c - r + r * beta of the sampling scheme, drawn once with a fixed seed; hashes pick from them."""
    rng = np.random.default_rng(SEED)
    r, log_c, beta = rng.gamma(2.0, 1.0, 65536), np.log(rng.gamma(2.0, 1.0, 65536)), rng.uniform(0.0, 1.0, 65536)
    return tuple(x.astype(np.float32) for x in (1 / r, beta, r, log_c - r + r * beta))


def samples(h: np.ndarray, weights: np.ndarray, draws, keys: np.ndarray) -> np.ndarray:
    """One consistent weighted sample for each key: a hash of the shingle chosen and its level.

    A key, an odd number, picks a shingle's draws by the upper bits of its product with the shingle's hash.
    """
    inverse, beta, r, offset = draws
    lowest, out = np.full(len(keys), np.inf, np.float32), np.zeros(len(keys), np.uint64)
    row, factors = np.arange(len(keys)), keys.astype(np.uint32)[:, None]
    for start in range(0, len(h), BLOCK):
        part = h[start : start + BLOCK]
        x = (part >> np.uint64(32)).astype(np.uint32)[None, :] * factors
        x = (x >> np.uint32(16)).astype(np.intp)
        t = np.log(weights[start : start + BLOCK]).astype(np.float32)[None, :] * inverse.take(x)
        t += beta.take(x)
        np.floor(t, out=t)
        a = offset.take(x)
        a -= r.take(x) * t
        at = a.argmin(1)
        least = a[row, at]
        own = _mixed(part[at] * MIX + t[row, at].astype(np.int64).astype(np.uint64))
        out = np.where(least < lowest, own, out)
        lowest = np.minimum(lowest, least)
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    words = F.trim(F.regexp_replace(text_of(), GAP, " "))
    return docs.select(whole_row(docs), words.alias("text")).withColumn("key", F.md5("text"))


def bands(rows: DataFrame, idf) -> DataFrame:
    """(key, bands) from (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws, table = _draws(), idf.value
        keys = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, dtype=np.int64).astype(np.uint64) | np.uint64(1)
        for batch in batches:
            out = []
            for h, n in shingles(batch["words"]):
                if not len(h):
                    out.append(None)
                    continue
                s = samples(h, n * table[_bucket(h)], draws, keys).reshape(BANDS, ROWS)
                band = np.arange(BANDS, dtype=np.uint64)
                for i in range(ROWS):
                    band = _mixed(band * MIX + s[:, i])
                out.append(band.astype(np.int64).tolist())
            yield pa.record_batch([batch["key"], pa.array(out, pa.list_(pa.int64()))], names=["key", "bands"])
        pa.default_memory_pool().release_unused()

    return rows.select("key", hashed(F.col("text")).alias("words")).mapInArrow(run, "key string, bands array<long>")


def similar(pairs: DataFrame, idf, least: float = LEAST) -> DataFrame:
    """Those pairs (a, b, text_a, text_b) whose weighted Jaccard similarity is ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for batch in batches:
            keep = []
            for (ha, na), (hb, nb) in zip(shingles(batch["text_a"]), shingles(batch["text_b"]), strict=True):
                _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
                wa, wb = table[_bucket(ha)].astype(float), table[_bucket(hb)].astype(float)
                common = (np.minimum(na[ia], nb[ib]) * wa[ia]).sum()
                keep.append(bool(common >= least * ((na * wa).sum() + (nb * wb).sum() - common) - 1e-9))
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch["a"].filter(mask), batch["b"].filter(mask)], names=["a", "b"])
        pa.default_memory_pool().release_unused()

    words = [hashed(F.col(c)).alias(c) for c in ("text_a", "text_b")]
    return pairs.select("a", "b", *words).mapInArrow(run, "a string, b string")


def verified(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """The similar ones of the pairs (a, b) of keys of texts (key, text)."""
    full = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return similar(full.select("a", "b", "text_a", "text_b"), idf)


def cells(spread: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, x, y, side, key, root): nodes of ``spread`` (key, band) dealt into cells in which all pairs across classes of a band meet.

    The nodes outside a band's largest class are held against all of its nodes, so that class is never paired with itself.
    Blocks are numbered by a hash: those of the other classes from 0 up, those of the largest class from -1 down. In a cell (x, y)
    block x is on side 0 and block y on side 1.
    """
    nodes = spread.join(roots, "key", "left").select("band", "key", F.coalesce("root", "key").alias("root"))
    sizes = nodes.groupBy("band", "root").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n"), F.count("*").alias("k"))
    blocks = lambda n: F.ceil(n / CELL).cast("int")
    mixed = mixed.filter("k > 1").select("band", "main", blocks(F.col("most")).alias("mains"), blocks(F.col("n") - F.col("most")).alias("others"))
    own = F.xxhash64(F.lit(SEED), "key")
    is_main = F.col("root") == F.col("main")
    block = F.when(is_main, -1 - F.pmod(own, "mains")).otherwise(F.pmod(own, "others")).cast("int")
    nodes = nodes.join(mixed, "band").withColumn("block", block)
    every = F.sequence(F.when(is_main, 0).otherwise(-F.col("mains")), F.col("others") - 1)
    meets = nodes.select("band", "key", "root", "block", F.explode(every).alias("other"))
    x, y = F.least("block", "other"), F.greatest("block", "other")
    return meets.select("band", x.alias("x"), y.alias("y"), (F.col("block") > F.col("other")).cast("int").alias("side"), "key", "root")


def common_weights(left: list[tuple], right: list[tuple], table: np.ndarray) -> np.ndarray:
    """What each text of ``left`` and each of ``right``, given as their ``counted`` shingles, have in common: the sum of the smaller weights."""

    def flat(texts):
        # a shingle that occurs c times is c members, the first to the c-th, so that texts become sets
        row = np.repeat(np.arange(len(texts)), [int(n.sum()) for _, n in texts])
        h, n = (np.concatenate([t[i] for t in texts]) for i in (0, 1))
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return row, np.repeat(h, n), nth

    (row_a, ha, ia), (row_b, hb, ib) = flat(left), flat(right)
    met = np.intersect1d(ha, hb)
    keep_a, keep_b = np.isin(ha, met), np.isin(hb, met)
    row_a, ha, ia, row_b, hb, ib = row_a[keep_a], ha[keep_a], ia[keep_a], row_b[keep_b], hb[keep_b], ib[keep_b]
    times = max(ia.max(initial=0), ib.max(initial=0)) + 1
    names, at = np.unique(np.concatenate([np.searchsorted(met, ha) * times + ia, np.searchsorted(met, hb) * times + ib]), return_inverse=True)
    at_a, at_b = at[: len(ha)], at[len(ha) :]
    weights = table[_bucket(met[names // times])].astype(float) if len(met) else np.zeros(0)
    out = np.zeros((len(left), len(right)))
    for start in range(0, len(names), WIDTH):
        a, b = np.zeros((len(left), WIDTH)), np.zeros((len(right), WIDTH))
        in_a, in_b = (at_a >= start) & (at_a < start + WIDTH), (at_b >= start) & (at_b < start + WIDTH)
        a[row_a[in_a], at_a[in_a] - start] = weights[at_a[in_a]]
        b[row_b[in_b], at_b[in_b] - start] = 1.0
        out += a @ b.T
    return out


def links_of(nodes: list[tuple], inner: bool, table: np.ndarray, least: float) -> list[tuple[str, str]]:
    """Similar pairs of different roots among the nodes (side, key, root, words) of a cell; ``inner`` where a block meets itself."""
    sides = [[n for n in nodes if inner or n[0] == side] for side in (0, 1)]
    if not all(sides) or len({n[2] for n in nodes}) < 2:
        return []
    left = [counted(n[3]) for n in sides[0]]
    right = left if inner else [counted(n[3]) for n in sides[1]]
    common = common_weights(left, right, table)
    size_a, size_b = (np.array([(n * table[_bucket(h)].astype(float)).sum() for h, n in texts]) for texts in (left, right))
    alike = common >= least * (size_a[:, None] + size_b[None, :] - common) - 1e-9
    pairs = ((sides[0][i], sides[1][j]) for i, j in np.argwhere(alike))
    return [(min(a[1], b[1]), max(a[1], b[1])) for a, b in pairs if a[2] != b[2]]


def linked(met: DataFrame, texts: DataFrame, idf, least: float = LEAST) -> DataFrame:
    """The similar pairs (a, b) of different roots that meet in a cell of ``met``, with texts (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cell, nodes = idf.value, None, []

        def found():
            links = sorted(set(links_of(nodes, cell[1] == cell[2], table, least))) if nodes else []
            return pa.record_batch([pa.array([p[i] for p in links], pa.string()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            words = batch["words"].values.to_numpy(zero_copy_only=False).view(np.uint64)
            at = batch["words"].offsets.to_pylist()
            named = zip(*[batch[c].to_pylist() for c in ("band", "x", "y", "side", "key", "root")], strict=True)
            for i, (band, x, y, *node) in enumerate(named):
                if cell != (band, x, y):
                    yield found()
                    cell, nodes = (band, x, y), []
                nodes.append((*node, words[at[i] : at[i + 1]].copy()))
        yield found()
        pa.default_memory_pool().release_unused()

    full = met.join(texts, "key").repartition("band", "x", "y").sortWithinPartitions("band", "x", "y")
    return full.select("band", "x", "y", "side", "key", "root", hashed(F.col("text")).alias("words")).mapInArrow(run, "a string, b string")


def classes(docs: DataFrame) -> DataFrame:
    """``row`` (all columns), key of its words, and root: the key of its class. A text without words has a null root."""
    rows = _keyed(docs)
    idf = docs.sparkSession.sparkContext.broadcast(document_frequencies(rows))
    signed = cut_lineage(bands(rows.select("key", "text"), idf).filter("bands is not null").groupBy("key").agg(F.first("bands").alias("bands")))
    spread = signed.select("key", F.explode("bands").alias("band"))
    ends = spread.groupBy("band").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo < hi")
    met = spread.join(ends, "band")
    pairs = met.select(F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("key").alias("b")), F.struct(F.col("key").alias("a"), F.col("hi").alias("b")))).alias("p"))
    pairs = cut_lineage(pairs.select("p.*").filter("a < b").distinct())
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()  # every node that shares a band
    texts = cut_lineage(rows.select("key", "text").join(wanted, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")))
    links = cut_lineage(verified(pairs, texts, idf))
    roots = components(links)
    more = cut_lineage(linked(cells(spread, roots), texts, idf).distinct())
    if not more.isEmpty():
        roots = components(links.union(more))
    out = rows.select("row", "key", (F.col("text") != "").alias("some")).join(roots, "key", "left")
    return out.select("row", "key", F.when(F.col("some"), F.coalesce("root", "key")).alias("root"))


def members(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size): the class id is the smallest doc_id of the class."""
    slim = docs.select("doc_id", "text")
    rows = cut_lineage(classes(slim).select(F.col("row.doc_id").alias("doc_id"), "root"))
    ids = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    return rows.join(ids, "root", "left").select(
        "doc_id", F.coalesce("first", "doc_id").alias("class_id"), F.coalesce("n", F.lit(1)).cast("long").alias("class_size")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each class, and every text without words; same columns."""
    rows = classes(docs)
    chosen = rows.filter("root is not null").groupBy("root").agg(F.min_by("row", F.struct(F.col("row.doc_id").isNull(), "row.doc_id", "key")).alias("row"))
    out = chosen.select("row").unionAll(rows.filter("root is null").select("row"))
    return out.select(*unpacked(out, docs.columns))
