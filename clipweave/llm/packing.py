"""Filling fixed-capacity containers with items: sum-of-squares packing of documents measured in tokens."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.session import cut

#: Fixed value: the splitting pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where the vocabulary is unless the session's setting `clipweave.tokenizer` names another file, which every worker can read.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CAPACITY = 2048
#: Items packed by one task, and open containers merged by one task.
SHELF = 100_000


@cache
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenizer_of(spark: SparkSession) -> str:
    """The vocabulary file of a session."""
    return spark.conf.get("clipweave.tokenizer", TOKENIZER)


def token_counts(documents: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(`key`, tokens) of every row by a byte-level vocabulary; null counts as empty. Whole texts are read."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokenizer).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=[key, "tokens"])

    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, tokens bigint")


class SumOfSquares:
    """Containers filled online: each item goes where the squared counts of equally filled open containers grow least.

    `open` counts the open containers by fill level. Putting size s on level h changes the sum of squares by
    2 (open[h + s] - open[h]) + 2, on a new container by 2 open[s] + 1; a container that becomes full leaves the count.
    Ties go to the fuller container.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open = np.zeros(capacity + 1, np.int64)
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.containers = 0

    def put(self, size: int) -> int:
        """The container of an item of 1..capacity."""
        c, count = self.capacity, self.open
        levels = np.flatnonzero(count[: c - size + 1])
        best, at = (2 * count[size] + 1 if size < c else 0), 0
        if len(levels):
            grown = 2 * (count[levels + size] * (levels + size < c) - count[levels]) + 2 - (levels + size == c)
            i = len(levels) - 1 - int(np.argmin(grown[::-1]))
            if grown[i] <= best:
                at = int(levels[i])
        if at:
            self.open[at] -= 1
            box = self.stacks[at].pop()
        else:
            box = self.containers
            self.containers += 1
        if at + size < c:
            self.open[at + size] += 1
            self.stacks[at + size].append(box)
        return box


def pack(items: DataFrame, *, key: str = "doc_id", size: str = "tokens", capacity: int = CAPACITY, seed: int = 0) -> DataFrame:
    """(`key`, container, part, offset, used): where every item lies.

    Items are shuffled into shelves of about SHELF items; a task packs a shelf in hash order, which is as good as random
    order and the same on every run. Then the containers left open on all shelves are packed once more, as items of
    their own, in groups of SHELF; so little room is left whatever the number of shelves. An item larger than the
    capacity is cut: it fills containers of its own (part 0, 1, ...), and its rest is packed like an item. `offset` is the
    place of the part in its container, `used` its length. Items of size null, 0 or less take no room and get no row.
    `items` has one row per `key`; an empty table gives an empty result; other columns are ignored.
    """
    kind = items.schema[key].dataType.simpleString()
    sized = items.where((F.col(size) > 0) & F.col(key).isNotNull()).select(F.col(key), F.col(size).cast("long").alias("size"), F.xxhash64(F.lit(seed), F.col(key)).alias("h"))
    sized = cut(sized, "pack-items")
    shelves = max(1, -(-sized.count() // SHELF))
    shelved = sized.withColumn("shelf", F.pmod("h", F.lit(shelves)).cast("int"))

    def first(table: pa.Table) -> pa.Table:
        h, sizes = table["h"].to_numpy(), table["size"].to_numpy()
        order = np.argsort(h, kind="stable")
        order = order[np.lexsort((np.asarray(table[key].to_pylist(), object)[order].astype(str), h[order]))] if len(np.unique(h)) < len(h) else order
        packer, rows = SumOfSquares(capacity), []
        fill: dict[int, int] = {}
        for i in order:
            rest, part = int(sizes[i]), 0
            while rest > capacity:
                box = packer.containers
                packer.containers += 1
                fill[box] = capacity
                rows.append((i, box, part, 0, capacity))
                rest, part = rest - capacity, part + 1
            box = packer.put(rest)
            rows.append((i, box, part, fill.get(box, 0), rest))
            fill[box] = fill.get(box, 0) + rest
        cols = list(zip(*rows)) if rows else [()] * 5
        return pa.table({
            key: table[key].take(pa.array(cols[0], pa.int64())), "shelf": pa.array([table["shelf"][0].as_py()] * len(rows), pa.int32()),
            "box": pa.array(cols[1], pa.int64()), "part": pa.array(cols[2], pa.int32()), "offset": pa.array(cols[3], pa.int64()), "used": pa.array(cols[4], pa.int64()),
        })

    spec = f"`{key}` {kind}, shelf int, box bigint, part int, offset bigint, used bigint"
    placed = cut(shelved.groupBy("shelf").applyInArrow(first, spec), "pack-first")
    boxes = placed.groupBy("shelf", "box").agg(F.sum("used").alias("fill"))
    loose = cut(boxes.where(F.col("fill") < capacity).select("shelf", "box", "fill", F.xxhash64(F.lit(seed + 1), "shelf", "box").alias("h")), "pack-loose")
    groups = max(1, -(-loose.count() // SHELF))

    def second(table: pa.Table) -> pa.Table:
        fills, boxes_, shelf = table["fill"].to_numpy(), table["box"].to_numpy(), table["shelf"].to_numpy()
        # Large pieces first: what is left open after the first pass is few and mostly large.
        order = np.lexsort((boxes_, shelf, -fills))
        packer, fill, out = SumOfSquares(capacity), {}, []
        for i in order:
            box = packer.put(int(fills[i]))
            out.append((box, fill.get(box, 0)))
            fill[box] = fill.get(box, 0) + int(fills[i])
        to, base = zip(*out)
        return pa.table({
            "shelf": pa.array(shelf[order], pa.int32()), "box": pa.array(boxes_[order], pa.int64()),
            "group": pa.array([table["group"][0].as_py()] * len(out), pa.int32()), "to": pa.array(to, pa.int64()), "base": pa.array(base, pa.int64()),
        })

    grouped = loose.withColumn("group", F.pmod("h", F.lit(groups)).cast("int"))
    merged = grouped.groupBy("group").applyInArrow(second, "shelf int, box bigint, group int, to bigint, base bigint")
    name = F.when(F.col("to").isNull(), F.format_string("%d-%d", "shelf", "box")).otherwise(F.format_string("m%d-%d", "group", "to"))
    out = placed.join(merged, ["shelf", "box"], "left")
    return out.select(key, name.alias("container"), "part", (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"), "used")
