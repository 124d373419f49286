"""Most similar vectors for every vector: inverted file of coarse cells, product-quantised residuals, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipweave.llm import codes
from clipweave.llm import vectors as V
from clipweave.session import cut

#: Rows a room, the part of the index that one task searches, is made for. Rooms of more than MOST_ROOM rows are divided
#: once more, by centroids fitted in tasks, so that the size of a room doesn't grow with the collection.
ROOM_ROWS = 8_000
MOST_ROOM = 64_000
#: Rooms told apart in one step. Their centroids are sent to every task (3 MB at 192 dimensions); two steps make 16 million.
FAN = 4096
#: Rows a cell is made for; cells are fitted within a room, so what a row is compared with doesn't grow with the collection.
ROWS_PER_CELL = 450
#: Sampled rows per cell on which centroids and codebooks are fitted, and the most rows the driver samples.
SAMPLED_PER_CELL = 16
MOST_SAMPLED = 65_536
#: Rooms, and cells of a room, in which a row is listed and looked for. Near vectors on either side of a border share one of them.
PROBES = 3
#: Parts of a residual quantised by themselves, one byte each.
PARTS = 24
#: Standard deviations that chance may bring a pair further apart, by codes or across a border, before a pair to be found is lost.
SIGMAS = 4.0
#: Estimated neighbours per wanted one that are ranked exactly where no least similarity is given.
RERANK = 12
#: Distinct vectors a task remembers having passed on already.
SEEN = 1_000_000


class Quantiser:
    """Centroids of rooms and one codebook for each part of the residuals, fitted on a bounded sample of unit vectors.

    The residuals that codebooks are fitted on are those to cells within the rooms, as they are searched later.
    """

    def __init__(self, sample: np.ndarray, rooms: int, parts: int = PARTS, seed: int = 0):
        self.rooms = V.fit_cells(sample, rooms, seed=seed)
        dims = sample.shape[1]
        self.parts = next(p for p in range(min(parts, dims), 0, -1) if dims % p == 0)
        best, _ = V.nearest(sample, self.rooms)
        self.shares = np.bincount(best, minlength=len(self.rooms)) / max(len(sample), 1)
        residual = np.empty_like(sample)
        for room in range(len(self.rooms)):
            at = np.flatnonzero(best == room)
            if len(at):
                cells = V.fit_cells(sample[at], max(1, len(at) // SAMPLED_PER_CELL), rounds=4, seed=seed)
                residual[at] = sample[at] - cells[V.nearest(sample[at], cells)[0]]
        residual /= np.maximum(np.sqrt(np.einsum("ij,ij->i", residual, residual)), 1e-9)[:, None]
        self.books = np.stack([_codebook(residual[:, p * (dims // self.parts) : (p + 1) * (dims // self.parts)], seed + p) for p in range(self.parts)])

    def encode(self, x: np.ndarray, centre: np.ndarray, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the rows' residuals to the centre of a cell; and of each row the gain, the squared length of what the codes leave
        out, and the squared length of what they stand for.

        The codes tell the direction of a residual, the gain its length, so that one set of codebooks serves cells of any spread.
        """
        width = x.shape[1] // self.parts
        out, facts = np.empty((len(x), self.parts), np.uint8), np.empty((len(x), 3), np.float32)
        halves = [0.5 * np.einsum("ij,ij->i", book, book) for book in self.books]
        for s in range(0, len(x), block):  # blocks that stay in the cache
            residual = x[s : s + block] - centre
            gain = np.sqrt(np.einsum("ij,ij->i", residual, residual))
            shape = residual / np.maximum(gain, 1e-9)[:, None]
            coded = np.empty_like(shape)
            for p, book in enumerate(self.books):
                r = np.ascontiguousarray(shape[:, p * width : (p + 1) * width])
                score = r @ book.T
                score -= halves[p]
                out[s : s + block, p] = score.argmax(axis=1)
                coded[:, p * width : (p + 1) * width] = book[out[s : s + block, p]]
            coded *= gain[:, None]
            gap, stands = residual - coded, centre + coded
            facts[s : s + block] = np.stack([gain, np.einsum("ij,ij->i", gap, gap), np.einsum("ij,ij->i", stands, stands)], axis=1)
        return out, facts

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Asymmetric tables: for each part the products of every codeword with every query, as (part, codeword, query)."""
        width = queries.shape[1] // self.parts
        return np.stack([book @ queries[:, p * width : (p + 1) * width].T for p, book in enumerate(self.books)])


def _codebook(r: np.ndarray, seed: int, size: int = 256, rounds: int = 6) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = r[rng.permutation(len(r))[:size]].copy() if len(r) >= size else np.resize(r, (size, r.shape[1])).copy()
    for _ in range(rounds):
        best = (r @ c.T - 0.5 * np.einsum("ij,ij->i", c, c)).argmax(axis=1)
        count = np.bincount(best, minlength=size)
        sums = V.group_sums(r, best, size)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
    return c.astype(np.float32)


def compare(q: Quantiser, centre: np.ndarray, x: np.ndarray, k: int, least: float | None, rerank: int = RERANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other row, cosine) of the near pairs among the rows of one cell, by tables first and exactly after.

    The tables give the distance of a query to what a row's codes stand for. With `least` all pairs are computed exactly
    whose distance isn't further than such a pair's can be but for chance (SIGMAS); else each row's nearest rerank * k.
    With `least` a pair is looked at from one side only.
    """
    code, facts = q.encode(x, centre)
    gain, left, stands = facts.T
    if least is not None:
        apart = np.sqrt(max(0.0, 2 - 2 * least))
        reach = apart**2 + left + 2 * apart * np.sqrt(left) * (SIGMAS / np.sqrt(x.shape[1])) + 1e-4
        bar = (1 + stands - reach) / 2
    found = []
    rows = np.arange(len(x))
    for s in range(0, len(rows), 64):
        mine = rows[s : s + 64]
        others = rows[s:] if least is not None else rows
        tables, base = q.tables(x[mine]), x[mine] @ centre
        kept = []
        for t in range(0, len(others), 1024):
            them = others[t : t + 1024]
            codes_ = code[them].astype(np.intp)
            product, one = np.zeros((len(them), len(mine)), np.float32), np.empty((len(them), len(mine)), np.float32)
            for p in range(q.parts):
                np.take(tables[p], codes_[:, p], axis=0, out=one, mode="clip")
                product += one
            product *= gain[them][:, None]
            product += base
            if least is not None:
                c, r = np.nonzero(product >= bar[them][:, None])
                kept.append((r, them[c]))
            else:
                kept.append(2 * product - stands[them][:, None])
        if least is not None:
            r, b = (np.concatenate(f) for f in zip(*kept))
            a = mine[r]
        else:
            near = np.concatenate(kept)
            top = min(rerank * k + 1, len(others))
            b = others[np.argpartition(-near, top - 1, axis=0)[:top].ravel("F")]
            a = np.repeat(mine, top)
        ok = a < b if least is not None else a != b
        a, b = a[ok], b[ok]
        cosine = np.empty(len(a), np.float32)
        for t in range(0, len(a), 4096):
            cosine[t : t + 4096] = np.einsum("ij,ij->i", x[a[t : t + 4096]], x[b[t : t + 4096]])
        if least is not None:
            near = cosine >= least
            a, b, cosine = a[near], b[near], cosine[near]
        found.append((a, b, cosine))
    a, b, cosine = (np.concatenate(f) for f in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.float32))
    if least is not None:
        a, b, cosine = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([cosine, cosine])
    return _lists(a, b, cosine, k)


def _lists(a: np.ndarray, b: np.ndarray, cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs of every row the k of highest cosine, each pair once; ties go to the smaller row."""
    order = np.lexsort((b, -cosine, a))
    a, b, cosine = a[order], b[order], cosine[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])  # copies of a pair have one cosine, so they stand together
    a, b, cosine = a[fresh], b[fresh], cosine[fresh]
    keep = np.arange(len(a)) - np.searchsorted(a, a, "left") < k
    return a[keep], b[keep], cosine[keep]


def search_room(q: Quantiser, x: np.ndarray, k: int, least: float | None, probes: int, rows_per_cell: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other row, cosine): the k nearest rows of every row within one room, through cells fitted on a sample of the room."""
    cells = max(1, round(len(x) / rows_per_cell))
    picked = x[np.linspace(0, len(x) - 1, min(len(x), max(cells * SAMPLED_PER_CELL, 64))).astype(np.int64)]
    centres = V.fit_cells(picked, cells, rounds=6)
    tops = V.top_cells(x, centres, probes)
    cell, row = tops.ravel(), np.repeat(np.arange(len(x)), tops.shape[1])
    order = np.argsort(cell, kind="stable")
    edges = np.searchsorted(cell[order], np.arange(len(centres) + 1))
    parts = []
    for c in range(len(centres)):
        at = row[order[edges[c] : edges[c + 1]]]
        if len(at) > 1:
            a, b, cosine = compare(q, centres[c], x[at], k, least)
            parts.append((at[a], at[b], cosine))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    return _lists(*(np.concatenate(f) for f in zip(*parts)), k)


def rooms_of(x: np.ndarray, centres: np.ndarray, probes: int, least: float | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, room) numbers: the nearest room of every row, and of the next ones up to `probes` those it may have a neighbour in.

    With `least` that is told from the distance to the border of both rooms: of a neighbour's offset, whose length is
    known, the part along any one direction is small but for chance (SIGMAS). Without it all of them are taken.
    """
    tops = V.top_cells(x, centres, probes)
    keep = np.ones(tops.shape, bool)
    if least is not None:
        reach = SIGMAS * np.sqrt(max(0.0, 2 - 2 * least) / x.shape[1])
        own = np.einsum("ij,ij->i", x, centres[tops[:, 0]])
        for p in range(1, tops.shape[1]):
            apart = centres[tops[:, 0]] - centres[tops[:, p]]
            gap = own - np.einsum("ij,ij->i", x, centres[tops[:, p]])
            keep[:, p] = gap <= reach * np.sqrt(np.einsum("ij,ij->i", apart, apart))
    at = np.nonzero(keep)
    return at[0], tops[at]


def vector_hashes(packed: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of packed vectors; equal directions have equal hashes."""
    rows = np.ascontiguousarray(packed)
    if rows.shape[1] * 2 % 8:
        rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 4)))
    words = rows.view(np.uint64)
    with np.errstate(over="ignore"):
        weights = codes.mix(np.arange(1, words.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        return codes.mix((codes.mix(words) * weights).sum(axis=1, dtype=np.uint64)).view(np.int64)


def nearest_vectors(records: DataFrame, *, k: int = 5, least: float | None = None, key: str = "id", column: str = "speaker_embedding", dims: int = 192, rows_per_cell: int = ROWS_PER_CELL, room_rows: int = ROOM_ROWS, most_room: int = MOST_ROOM, fan: int = FAN, probes: int = PROBES) -> DataFrame:
    """(`key`, neighbour, similarity, rank): the k records most similar to every record, by cosine; with `least` only those reaching it.

    Usable are vectors of `dims` finite values that aren't all zero; records without one have no row. A key delivered
    more than once counts once. Records with the same direction are one vector of the index, whose list holds the
    smallest keys first among equals, so a vector that a third of all records share costs one entry per task and no
    pairs. Ties go to the smaller key. An empty table gives an empty result; other columns are ignored.

    The inverted file has two levels. Rooms have centroids fitted on a bounded sample at the driver, and where a
    collection needs more than `fan` of them, rooms above `most_room` rows are divided by centroids that tasks fit on a
    sample of the room. Cells are fitted within a room by the task that searches it. So the rows of a room and of a cell
    stay the same at every size, and with them the work per row. Every vector is indexed and is a query, in its nearest
    room and, near a border, in up to `probes`; it travels once per room, as 16-bit integers.
    """
    spark = records.sparkSession
    given = records.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(key, column)
    kind = records.schema[key].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = V.unit_rows(batch.column(1), dims)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(vector_hashes(np.rint(x * V.SCALE).astype(np.int16)))], names=["k", "h"])

    names = cut(given.mapInArrow(hashed, f"k {kind}, h bigint").distinct(), "knn-names")
    n = names.count()
    if not n:
        return spark.createDataFrame([], f"`{key}` {kind}, neighbour {kind}, similarity float, rank int")
    rooms = int(min(fan, max(1, n // room_rows)))
    sampled = min(MOST_SAMPLED, max(1024, SAMPLED_PER_CELL * rooms, SAMPLED_PER_CELL * n // rows_per_cell))
    quantiser = Quantiser(V.sample(given, key, column, dims, sampled), rooms)
    shared = spark.sparkContext.broadcast(quantiser)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            _, x = V.unit_rows(batch.column(0), dims)
            h = vector_hashes(np.rint(x * V.SCALE).astype(np.int16))
            if len(seen) > SEEN:
                seen.clear()
            fresh = [i for i, v in enumerate(h.tolist()) if not (v in seen or seen.add(v))]
            x, h = x[fresh], h[fresh]
            row, room = rooms_of(x, shared.value.rooms, probes, least)
            yield pa.RecordBatch.from_arrays([pa.array(room.astype(np.int64)), pa.array(h[row]), V.pack(x[row])], names=["room", "h", "v"])

    index = given.select(column).mapInArrow(listed, "room bigint, h bigint, v binary")
    large = {r: int(-(-s * n // room_rows)) for r, s in enumerate(quantiser.shares.tolist()) if s * n > most_room}
    if large:
        index = _divided(index, large, fan, room_rows, max(1, most_room // room_rows), dims, probes, least)

    def searched(table: pa.Table) -> pa.Table:
        h = table["h"].to_numpy()
        _, first = np.unique(h, return_index=True)  # in order of the hash, so that a repeated task sees the same cells
        table, h = table.take(pa.array(first)), h[first]
        a, b, cosine = search_room(shared.value, V.unpack(table["v"], dims), k, least, probes, rows_per_cell)
        return pa.table({"a": pa.array(h[a]), "b": pa.array(h[b]), "s": pa.array(cosine.astype(np.float32))})

    pairs = index.groupBy("room").applyInArrow(searched, "a bigint, b bigint, s float")
    # A pair may come from several rooms, with one and the same similarity.
    best = pairs.groupBy("a", "b").agg(F.max("s").alias("s"))
    near = best.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))).where(F.col("r") <= k)
    return _by_key(cut(near.select("a", "b", "s"), "knn-pairs"), names, k, key)


def _divided(index: DataFrame, large: dict[int, int], fan: int, room_rows: int, hands: int, dims: int, probes: int, least: float | None) -> DataFrame:
    """`index` with the rows of `large` rooms {room: parts} moved to parts of them: the second level of rooms.

    A room's centroids are fitted by a task on SAMPLED_PER_CELL rows a part, picked by their hash. Its rows are dealt to
    `hands` tasks for every `hands` parts, each with all centroids of the room; so no task gathers a large room.
    """
    spark = index.sparkSession
    facts = spark.createDataFrame([(r, min(fan, p), max(1, -(-p // hands))) for r, p in large.items()], "room bigint, parts int, hands int")
    marked = index.join(F.broadcast(facts), "room", "left")  # at most FAN rows
    big = marked.where("parts IS NOT NULL")
    every = max(1, room_rows // SAMPLED_PER_CELL)

    def fit(table: pa.Table) -> pa.Table:
        order = np.argsort(table["h"].to_numpy(), kind="stable")
        parts = table["parts"][0].as_py()
        x = V.unpack(table["v"].take(pa.array(order[: parts * 2 * SAMPLED_PER_CELL])), dims)
        centres = V.fit_cells(x, parts)
        return pa.table({"room": pa.array([table["room"][0].as_py()]), "hands": pa.array([table["hands"][0].as_py()], pa.int32()), "centres": pa.array([centres.astype(np.float32).tobytes()], pa.binary())})

    sample = big.where(F.pmod(F.xxhash64("h"), F.lit(every)) == 0)
    fitted = cut(sample.groupBy("room").applyInArrow(fit, "room bigint, hands int, centres binary"), "knn-rooms")
    offered = fitted.select("room", "centres", F.explode(F.sequence(F.lit(0), F.col("hands") - 1)).alias("hand"))
    dealt = big.select("room", F.pmod("h", "hands").cast("int").alias("hand"), "h", "v")

    def route(rows: pa.Table, centres: pa.Table) -> pa.Table:
        if not len(rows) or not len(centres):
            return rows.select(["room", "h", "v"])
        x = V.unpack(rows["v"], dims)
        row, part = rooms_of(x, np.frombuffer(centres["centres"][0].as_py(), np.float32).reshape(-1, dims), probes, least)
        moved = rows.take(pa.array(row))
        return pa.table({"room": pa.array((rows["room"][0].as_py() + 1 << 32) + part.astype(np.int64)), "h": moved["h"], "v": moved["v"]})

    parted = dealt.groupBy("room", "hand").cogroup(offered.groupBy("room", "hand")).applyInArrow(route, "room bigint, h bigint, v binary")
    return marked.where("parts IS NULL").select("room", "h", "v").unionByName(parted)


def _by_key(pairs: DataFrame, names: DataFrame, k: int, key: str) -> DataFrame:
    """Neighbours of vectors as neighbours of records: each vector's list holds its own records and those of its neighbours."""
    lead = Window.partitionBy("h").orderBy("k")
    heads = names.withColumn("r", F.row_number().over(lead)).where(F.col("r") <= k + 1).select("h", "k")
    copied = names.groupBy("h").count().where("count > 1").select("h")
    other = pairs.join(heads.select(F.col("h").alias("b"), F.col("k").alias("neighbour")), "b").select(F.col("a").alias("h"), "s", "neighbour")
    own = heads.join(copied, "h", "left_semi").select("h", F.lit(1.0).cast("float").alias("s"), F.col("k").alias("neighbour"))
    order = Window.partitionBy("h").orderBy(F.desc("s"), "neighbour")
    ranked = other.unionByName(own).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    lists = ranked.groupBy("h").agg(F.sort_array(F.collect_list(F.struct("r", "neighbour", "s"))).alias("near"))  # k + 1 entries at most
    out = names.join(lists, "h").select("k", F.slice(F.filter("near", lambda e: e["neighbour"] != F.col("k")), 1, k).alias("near"))
    out = out.select("k", F.posexplode("near").alias("rank", "e"))
    return out.select(F.col("k").alias(key), F.col("e.neighbour").alias("neighbour"), F.col("e.s").alias("similarity"), (F.col("rank") + 1).alias("rank"))
