"""Problem 4: the most similar vectors for every vector.

Shifted space-filling curves: the vectors are turned by several random rotations, each with its own
shift, and put in order along a Hilbert curve through the first few turned coordinates.  Every order is
range-partitioned at quantiles of its keys, and each range also gets the edges of the ranges beside it,
so that the windows along the order run on over the boundaries of the partitions.  In its window each
vector is held against WINDOW neighbours on either side, a block of vectors at a time by one matrix
product; the nearest of all orders merge and the k best are kept.  Equal vectors are one point of the
curves, represented by their least ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.lineage import cut
from leafmill.llm import flat
from leafmill.session import spread

DIMENSIONS = 64
#: Orders, coordinates of each and bits of each coordinate; points of one cell are ordered by TIE_BITS of their hash (all below 63 bits).
CURVES, AXES, BITS, TIE_BITS = 10, 6, 8, 14
#: Neighbours along an order that each vector is held against, on either side.
WINDOW = 4_096
#: Points of a range, about; those of its edges besides.
RANGE = 1 << 16
#: Vectors of one matrix product, and columns of it whose greatest is looked at first.
BLOCK, STRIDE = 128, 32
#: Neighbours kept by one window for each vector, besides those asked for.
SPARE = 1
#: The error of a cosine of 16-bit codes is far below it; pairs that near to a threshold are decided by their full vectors.
NEAR_THRESHOLD = 1e-4
#: Parts into which the members of one vector are dealt.
SALT = 64
#: Query vectors that a block of the brute-force measurement sends to the tasks.
QUERY_BLOCK = 2_000


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The position along a Hilbert curve of each row of cell numbers below 2**bits (Skilling's transposed form)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] = np.where(high, x[i], x[i] ^ t)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def rotations(curves: int, axes: int, dimensions: int, seed: int = 7) -> np.ndarray:
    """(curve, dimension, axis): orthonormal directions, drawn anew for each curve."""
    r = np.random.default_rng(seed)
    return np.stack([np.linalg.qr(r.normal(size=(dimensions, axes)))[0] for _ in range(curves)])


def live_vectors(index: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(chunk_id, unit, same): the unit vector of each live chunk and its 128-bit digest, one row each.

    Live: of version v3, not null, without null or NaN or infinite parts, not all zero, of the index's dimension (others
    cannot be compared).  Repeated rows fall together; of different live vectors of one chunk the latest holds."""
    v = F.col("embedding")
    usable = (
        (F.col("embedding_version") == "v3")
        & F.col("chunk_id").isNotNull()
        & v.isNotNull()
        & (F.size(v) == dimensions)
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    rows = index.select("chunk_id", "embedding", "embedding_version", "updated_at").filter(usable)
    newest = rows.groupBy("chunk_id").agg(F.max(F.struct("updated_at", "embedding"))["embedding"].alias("embedding"))

    def unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["embedding"].tolist(), np.float64).reshape(-1, dimensions)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            yield pd.DataFrame({"chunk_id": batch["chunk_id"], "unit": [r.tobytes() for r in x.astype(np.float32)]})

    units = newest.select("chunk_id", "embedding").mapInPandas(flat.filled(unit), "chunk_id string, unit binary")
    return units.withColumn("same", F.unhex(F.md5("unit")))


def salt() -> Column:
    """The part of its vector's members that a chunk is dealt to."""
    return F.pmod(F.xxhash64("chunk_id"), F.lit(SALT)).cast("int")


def points(live: DataFrame, k: int, asked: Column | None = None) -> DataFrame:
    """(point, same, unit, members, salts, asked): the different vectors, each with the k + 1 least ids of its members.

    The members are dealt into SALT parts before their least ids are taken, so a vector that very many chunks share is no hot
    group; `salts` are the parts that occur.  A point is asked for if one of its members is (all, where nothing is said)."""
    dealt = live.select("chunk_id", "same", salt().alias("salt"), (F.lit(True) if asked is None else asked).alias("asked"))
    part = Window.partitionBy("same", "salt")
    few = dealt.withColumn("_n", F.row_number().over(part.orderBy("chunk_id"))).withColumn("asked", F.max("asked").over(part))
    few = few.filter(F.col("_n") <= k + 1)
    each = few.groupBy("same").agg(
        F.slice(F.array_sort(F.collect_list("chunk_id")), 1, k + 1).alias("members"),
        F.collect_set("salt").alias("salts"),
        F.max("asked").alias("asked"),
    )
    first = live.select(F.col("chunk_id").alias("_first"), "unit")
    each = each.join(first, F.element_at("members", 1) == F.col("_first")).drop("_first")
    return each.withColumn("point", F.monotonically_increasing_id())


def _coded(x: np.ndarray) -> np.ndarray:
    """Vectors as 16-bit numbers, each on the scale of its greatest part."""
    return np.rint(x * (32767.0 / np.abs(x).max(axis=1, keepdims=True))).astype(np.int16)


def _keyed(found: DataFrame, curves: int, dimensions: int) -> DataFrame:
    """(point, asked, code, keys): each point's 16-bit vector and its place along every order."""
    turn = rotations(curves, AXES, dimensions).astype(np.float32)
    shift = np.random.default_rng(11).uniform(0, 1, size=(curves, AXES))
    scale = np.float32(0.8 * np.sqrt(dimensions))  # turned coordinates of unit vectors spread by about 1 / sqrt(dimensions)

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch["unit"]), np.float32).reshape(-1, dimensions)
            codes = _coded(x)
            tie = (codes.astype(np.int64) @ (np.arange(1, dimensions + 1) * 2654435761 % 1048573)) % 1048573 % (1 << TIE_BITS)
            out = np.empty((len(x), curves), np.int64)
            for c in range(curves):
                z = 0.5 * (1 + np.tanh(scale * (x @ turn[c])))  # about even over the cells
                cells = np.clip(((z * 0.9 + 0.1 * shift[c]) * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
                out[:, c] = (hilbert_keys(cells, BITS) << TIE_BITS) | tie
            yield pd.DataFrame({"point": batch["point"], "asked": batch["asked"], "code": [r.tobytes() for r in codes], "keys": list(out)})

    kind = "point long, asked boolean, code binary, keys array<long>"
    return found.select("point", "asked", "unit").mapInPandas(flat.filled(keys), kind)


def _bounds(keyed: DataFrame, curves: int, n: int) -> np.ndarray:
    """(curve, boundary, (key WINDOW points before, key at it, key WINDOW points after)) of the ranges of every order.

    The quantiles are approximate, within a quarter of a window; there is a boundary for RANGE points, so what is known of them
    on the driver is a small part of the points' number."""
    parts = -(-n // RANGE)
    if parts < 2:
        return np.empty((curves, 0, 3), np.int64)
    at = np.arange(1, parts) / parts
    wanted = np.stack([np.maximum(at - WINDOW / n, 0), at, np.minimum(at + WINDOW / n, 1)], axis=1).ravel().tolist()
    accuracy = max(10_000, 4 * n // WINDOW)
    row = keyed.agg(*(F.percentile_approx(F.col("keys")[c], wanted, accuracy).alias(f"c{c}") for c in range(curves))).first()
    return np.array([row[c] for c in range(curves)], np.int64).reshape(curves, parts - 1, 3)


def _nearest(x: np.ndarray, codes: np.ndarray, rows: np.ndarray, low: int, high: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, cosines) of the `keep` greatest cosines of each row with the points from low to high, itself left out.

    The greatest of every STRIDE columns is looked at first: the `keep` greatest stand in the `keep` best of those."""
    width = -(-(high - low) // STRIDE) * STRIDE
    c = np.full((len(rows), width), -3.0, np.float32)
    c[:, : high - low] = x[rows] @ x[low:high].T
    c[np.arange(len(rows)), rows - low] = -2.0
    peaks = c.reshape(len(rows), -1, STRIDE).max(axis=2)
    some = min(keep, peaks.shape[1])
    best = np.argpartition(-peaks, some - 1, axis=1)[:, :some] if some < peaks.shape[1] else np.tile(np.arange(some), (len(rows), 1))
    columns = (best[:, :, None] * STRIDE + np.arange(STRIDE)).reshape(len(rows), -1)
    values = np.take_along_axis(c, columns, 1)
    top = np.argpartition(-values, keep - 1, axis=1)[:, :keep] if keep < values.shape[1] else np.tile(np.arange(values.shape[1]), (len(rows), 1))
    real = np.take_along_axis(values, top, 1) > -2.0
    places = np.where(real, low + np.take_along_axis(columns, top, 1), rows[:, None])
    own, far = codes[rows].astype(np.int64), codes[places].astype(np.int64)
    # whole numbers: the same for a pair in every order and either way round
    cosine = np.einsum("ij,ikj->ik", own, far) / np.sqrt((own * own).sum(1)[:, None] * (far * far).sum(2).astype(np.float64))
    return places, np.where(real, cosine, -2.0)


def near_points(found: DataFrame, k: int, least: float = -1.0, curves: int = CURVES, dimensions: int = DIMENSIONS) -> DataFrame:
    """(a, b, cosine): the k + SPARE nearest other points of each point asked for, approximately; pairs below `least` are left out."""
    keyed = cut(_keyed(found, curves, dimensions))
    n = keyed.count()
    bounds, keep = _bounds(keyed, curves, n), k + SPARE
    parts = bounds.shape[1] + 1
    floor = least - NEAR_THRESHOLD

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = np.array(batch["keys"].tolist(), np.int64).reshape(-1, curves)
            asked = batch["asked"].to_numpy(bool)
            for c in range(curves):
                before, at, after = bounds[c].T
                home = np.searchsorted(at, keys[:, c], side="right")
                first, last = np.searchsorted(after, keys[:, c], side="right"), np.searchsorted(before, keys[:, c], side="right")
                for step in (0, -1, 1):
                    part = home + step
                    here = (part >= np.minimum(first, home)) & (part <= np.maximum(last, home))
                    if here.any():
                        rows = batch.loc[here, ["point", "code"]]
                        yield rows.assign(part=(c * parts + part[here]).astype(np.int32), key=keys[here, c], home=asked[here] & (step == 0))

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = pd.concat(batches, ignore_index=True) if (batches := list(batches)) else None
        if block is None or len(block) < 2:
            return
        block = block.iloc[np.lexsort((block["point"], block["key"]))]
        ids, home = block["point"].to_numpy(), block["home"].to_numpy(bool)
        codes = np.frombuffer(b"".join(block["code"]), np.int16).reshape(-1, dimensions)
        x = codes.astype(np.float32)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for start in range(0, len(x), BLOCK):
            rows = start + np.flatnonzero(home[start : start + BLOCK])
            if len(rows):
                places, cosine = _nearest(x, codes, rows, max(0, rows[0] - WINDOW), min(len(x), rows[-1] + 1 + WINDOW), keep)
                held = cosine >= max(floor, -1.5)
                some = np.flatnonzero(held.any(axis=1))
                if len(some):
                    yield pd.DataFrame({"a": ids[rows[some]], "b": [ids[places[i][held[i]]] for i in some], "cosine": [cosine[i][held[i]] for i in some]})

    dealt = keyed.mapInPandas(flat.filled(deal), "point long, code binary, part int, key long, home boolean")
    dealt = dealt.repartitionById(curves * parts, "part")
    lists = dealt.mapInPandas(flat.filled(windows), "a long, b array<long>, cosine array<double>")
    pairs = F.transform(F.arrays_zip("cosine", "b"), lambda x: F.struct((-x["cosine"]).alias("far"), x["b"].alias("b")))
    merged = lists.select("a", pairs.alias("near")).groupBy("a").agg(F.flatten(F.collect_list("near")).alias("near"))
    best = merged.select("a", F.explode(F.slice(F.array_sort(F.array_distinct("near")), 1, keep)).alias("n"))
    best = best.select("a", F.col("n.b").alias("b"), (-F.col("n.far")).alias("cosine"))
    return best if least <= -1 else _decided(cut(best), found, least, dimensions)


def _decided(best: DataFrame, found: DataFrame, least: float, dimensions: int) -> DataFrame:
    """The pairs of at least that cosine; those near to it are held against each other by their full vectors."""
    close = F.abs(F.col("cosine") - least) < NEAR_THRESHOLD

    def cosine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            u, v = (np.frombuffer(b"".join(batch[x]), np.float32).reshape(-1, dimensions).astype(float) for x in "uv")
            c = np.einsum("ij,ij->i", u, v) / np.sqrt(np.einsum("ij,ij->i", u, u) * np.einsum("ij,ij->i", v, v))
            yield batch[["a", "b"]].assign(cosine=c)[c >= least]

    doubt = best.filter(close).select("a", "b")
    doubt = doubt.join(found.select(F.col("point").alias("a"), F.col("unit").alias("u")), "a")
    doubt = doubt.join(found.select(F.col("point").alias("b"), F.col("unit").alias("v")), "b")
    sure = doubt.select("a", "b", "u", "v").mapInPandas(flat.filled(cosine), "a long, b long, cosine double")
    return best.filter(~close & (F.col("cosine") >= least)).unionByName(sure)


def neighbours(index: DataFrame, k: int = 5, least: float = -1.0, dimensions: int = DIMENSIONS, asked: Column | None = None) -> DataFrame:
    """(chunk_id, other, cosine): for each live vector the k most similar other live vectors, equal cosines by the lesser id.

    `asked`, a condition on chunk_id, names the query vectors; all are searched for where it is not given, and against all in any
    case.  Members of one vector are each other's nearest, by their least ids; further ones come from the nearest points, again by
    their least ids.  Empty tables give no rows, a lone vector has no neighbour; extra columns are not read."""
    live = cut(live_vectors(index, dimensions))
    found = cut(points(live, k, asked))
    near = near_points(found, k, least, dimensions=dimensions)
    members = found.select(F.col("point").alias("b"), F.posexplode("members").alias("_p", "other"))
    own = found.filter("asked AND size(members) > 1").select(F.col("point").alias("a"), F.col("point").alias("b"), F.lit(1.0).alias("cosine"))
    offered = near.unionByName(own).join(members, "b").select("a", "other", "cosine")
    order = Window.partitionBy("a").orderBy(F.col("cosine").desc(), "other")
    # one more than asked for: a member leaves itself out
    offered = offered.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1).drop("_n")
    lists = offered.groupBy("a").agg(F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("far"), "other"))).alias("near"))
    # a list goes to each part of its point's members that occurs, so a point of very many members is no hot key
    lists = found.select(F.col("point").alias("a"), "same", "salts").join(lists, "a").select("same", F.explode("salts").alias("salt"), "near")
    each = live.filter(F.lit(True) if asked is None else asked).select("chunk_id", "same", salt().alias("salt")).join(lists, ["same", "salt"])
    nearest = F.slice(F.filter("near", lambda x: x["other"] != F.col("chunk_id")), 1, k)
    rows = each.select("chunk_id", F.explode(nearest).alias("n"))
    return rows.select("chunk_id", F.col("n.other").alias("other"), (-F.col("n.far")).alias("cosine")).filter(F.col("cosine") >= least)


def similar_pairs(index: DataFrame, k: int = 5, least: float = 0.9) -> DataFrame:
    """(chunk_a, chunk_b), chunk_a < chunk_b: pairs of at least that cosine of which one is among the k nearest of the other."""
    pairs = neighbours(index, k, least)
    return pairs.select(F.least("chunk_id", "other").alias("chunk_a"), F.greatest("chunk_id", "other").alias("chunk_b")).distinct()


def exact_neighbours(live: DataFrame, queries: DataFrame, k: int, dimensions: int = DIMENSIONS) -> DataFrame:
    """(chunk_id, other, cosine): the k nearest of all live vectors to each query vector, by brute force.

    The queries are a stated set; they are sent to the tasks in blocks of about QUERY_BLOCK vectors, each held against all
    rows.  For measuring the index, not for searching: the work grows as queries times rows."""
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    rows = spread(live.select("chunk_id", "unit"))
    parts = None
    for b in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("chunk_id", F.lit(3)), F.lit(blocks)) == b).select("chunk_id", "unit").collect()
        if not block:
            continue
        sent = live.sparkSession.sparkContext.broadcast((np.array([r.chunk_id for r in block], object), b"".join(r.unit for r in block)))

        def scan(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            ids, raw = sent.value
            q = np.frombuffer(raw, np.float32).reshape(-1, dimensions)
            best, names = np.full((len(ids), k), -2.0, np.float32), np.full((len(ids), k), None, object)
            for batch in batches:
                own = batch["chunk_id"].to_numpy()
                for i in range(0, len(own), 4096):
                    c = q @ np.frombuffer(b"".join(batch["unit"].iloc[i : i + 4096]), np.float32).reshape(-1, dimensions).T
                    c[ids[:, None] == own[None, i : i + 4096]] = -2.0
                    both, named = np.hstack([best, c]), np.hstack([names, np.broadcast_to(own[i : i + 4096], c.shape)])
                    top = np.argpartition(-both, k - 1, axis=1)[:, :k]
                    best, names = np.take_along_axis(both, top, 1), np.take_along_axis(named, top, 1)
            r, j = np.nonzero(best > -2.0)
            yield pd.DataFrame({"chunk_id": ids[r], "other": names[r, j], "cosine": best[r, j].astype(float)})

        part = rows.mapInPandas(flat.filled(scan), "chunk_id string, other string, cosine double")
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return live.sparkSession.createDataFrame([], "chunk_id string, other string, cosine double")
    order = Window.partitionBy("chunk_id").orderBy(F.col("cosine").desc(), "other")
    return parts.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def every_fiftieth() -> Column:
    """The stated query set: ids whose hash is divisible by 50."""
    return F.pmod(F.xxhash64("chunk_id"), F.lit(50)) == 0


def recall(index: DataFrame, k: int = 5) -> DataFrame:
    """One row: how many of the k nearest the index finds, whatever their cosine, for every fiftieth vector against all.

    A neighbour that is as near as the k-th nearest counts as found, so ties don't matter."""
    live = cut(live_vectors(index))
    queries = cut(live.filter(every_fiftieth()))
    exact = exact_neighbours(live, queries, k).groupBy("chunk_id").agg(F.count("*").alias("due"), F.min("cosine").alias("floor"))
    near = neighbours(index, k, asked=every_fiftieth()).select("chunk_id", "cosine")
    hits = near.join(exact, "chunk_id").filter(F.col("cosine") >= F.col("floor") - 1e-5).groupBy("chunk_id").agg(F.count("*").alias("hits"))
    held = exact.join(hits, "chunk_id", "left").agg(F.coalesce(F.sum("due"), F.lit(0)).alias("true_neighbours"), F.coalesce(F.sum("hits"), F.lit(0)).alias("found"))
    held = held.withColumn("recall", F.round(F.coalesce(F.try_divide("found", "true_neighbours"), F.lit(1.0)), 4))
    return held.withColumn("queries", F.lit(queries.count()))


def p4_found(spark, sf_dir: str) -> DataFrame:
    return similar_pairs(spark.read.parquet(f"{sf_dir}/vector_index.parquet"))


def p4_recall(spark, sf_dir: str) -> DataFrame:
    return recall(spark.read.parquet(f"{sf_dir}/vector_index.parquet"))


QUERIES = {"p4_found": p4_found, "p4_recall": p4_recall}
SQL: dict[str, str] = {}
