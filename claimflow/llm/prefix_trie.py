"""Prefix trie of conversations, screened by a count-min sketch of prefix digests.

A node is a distinct sequence of first d turns (role, text); the root is the empty one. Steps:

1. A turn becomes two 64-bit hashes and its byte count; texts go no further. Rows are dealt by ranges
   of (conversation, order), so a conversation of any length spans as many tasks as it needs, and one
   summary row a range (its last conversation so far) carries counts and digests into the next range.
2. A prefix's digest is a polynomial in its turns' hashes (twice 64 bits), so that digests of two parts
   of a conversation compose.
3. A count-min sketch of two rows counts the digests. Tasks send the cells they touched, blocks of cells
   are merged apart, and what is left is one bit a cell: counted twice or more. The sketch grows with
   the input up to ``MAX_CELLS`` cells a row (the broadcast's bound); a fuller one costs time, not results.
4. An estimate of one proves that a single conversation has the prefix, and so all longer ones: from
   there on its nodes are emitted by the task that reads them. Only the other rows are grouped.
5. A node belongs to its smallest member. Belonging is inherited towards longer prefixes, so each
   conversation owns one stretch of its path. All that is asked of subtrees is a sum over members of what
   their stretches say (children: does it own the next node; leaves: does it own a childless end;
   saved tokens: the bytes between the node and its stretch), so no level-by-level walk is needed.

Joins whose rows may hold a hot key take keys of more than a hundred-thousandth of the rows (so at most
100,000 keys, broadcast) apart from the others. A list of ended members is hashed in order from joined
pieces of at most 4,096 ids, so a task holds one piece.

Defined results: a null role or text is empty; a null turn comes first; turns of equal number are
ordered by their hashes; a repeated row is a turn of its own; texts are read whole; rows without a
conversation id belong to none and are left out; an empty table has no nodes, not even the root. Other
columns are left unread, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import settle

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so that they have inverses
INVERSES = tuple(pow(m, -1, 1 << 64) for m in MULTIPLIERS)
WORD = (1 << 64) - 1
MAX_CELLS = 1 << 27  # a row of the sketch: 16 MB of bits, twice
CELLS_PER_PREFIX = 8
FLUSH = 1 << 20
HOT_KEYS = 100_000
LEAST_HOT = 10_000
PIECE = 4096
NODE = ["v1", "v2", "depth"]


def turn_keys(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """conv_id, at (order), k1, k2 (hashes of role and text), nb (bytes of the text)."""
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    return turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("at"),
        F.xxhash64(F.lit(1), *said).alias("k1"), F.xxhash64(F.lit(2), *said).alias("k2"),
        F.octet_length(said[1]).cast("long").alias("nb"))


def deal(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in order, by ranges of ``keys``, with the number of the range; written once."""
    order = [F.col(k).asc_nulls_first() for k in keys]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()))


@dataclass
class Chain:
    """A conversation as far as it was read: rows, digests, bytes."""
    conv: int
    n: int = 0
    v1: int = 0
    v2: int = 0
    b: int = 0
    proven: bool = False


class Walker:
    """Running counts, digests and bytes of each conversation, over batches of ordered rows."""

    def __init__(self, state: Chain | None = None):
        self.state, self.size = state, 0

    def _powers(self, n: int) -> None:
        if n > self.size:
            self.size = n
            self.up, self.down = ([np.cumprod(np.array([1] + [m] * n, np.uint64), dtype=np.uint64) for m in ms]
                                  for ms in (MULTIPLIERS, INVERSES))

    def step(self, f: pd.DataFrame) -> dict[str, np.ndarray]:
        conv, n = f["conv_id"].to_numpy(), len(f)
        self._powers(n + 1)
        at = np.arange(n)
        new = np.concatenate([[self.state is None or self.state.conv != conv[0]], conv[1:] != conv[:-1]])
        start = np.maximum.accumulate(np.where(new, at, 0))
        first = (start == 0) & (not new[0])  # rows that go on with the carried conversation
        count = at - start + 1 + np.where(first, self.state.n if self.state else 0, 0)
        nb = f["nb"].to_numpy()
        total = np.cumsum(nb)
        before = total - nb - (total - nb)[start] + np.where(first, self.state.b if self.state else 0, 0)
        out = {"conv": conv, "count": count, "before": before, "nb": nb, "start": start, "first": first}
        for i, (up, down) in enumerate(zip(self.up, self.down, strict=True), 1):
            k = np.ascontiguousarray(f[f"k{i}"].to_numpy()).view(np.uint64)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(k * down[:n], dtype=np.uint64)])
            v = (sums[1:] - sums[start]) * up[:n]
            if self.state is not None:
                v = v + np.where(first, np.uint64(getattr(self.state, f"v{i}")) * up[1 : n + 1], np.uint64(0))
            out[f"v{i}"], out[f"p{i}"] = v, (v - k) * down[1]
        self.state = Chain(int(conv[-1]), int(count[-1]), int(out["v1"][-1]), int(out["v2"][-1]), int(before[-1] + nb[-1]))
        return out


def _edges(frames):
    walker, first, place = Walker(), None, 0
    rows = 0
    for f in frames:
        if len(f):
            first = int(f["conv_id"].iloc[0]) if first is None else first
            place, rows = int(f["_range"].iloc[0]), rows + len(f)
            walker.step(f)
    if (s := walker.state) is not None:
        signed = [int(np.uint64(v).view(np.int64)) for v in (s.v1, s.v2)]
        yield pd.DataFrame([(place, rows, first, s.conv, s.n, *signed, s.b)],
                           columns=["place", "n_rows", "first", "last", "n", "v1", "v2", "b"])


def carried(dealt: DataFrame) -> tuple[dict[int, Chain], dict[int, int], int]:
    """What each range begins with, the conversation that follows each range, and the number of rows.
    One summary row a range comes to the driver, whatever the ranges hold."""
    rows = dealt.mapInPandas(_edges, "place int, n_rows long, first long, last long, n long, v1 long, v2 long, b long").collect()
    begin, follows, state, prior = {}, {}, None, None
    for e in sorted(rows, key=lambda e: e.place):
        if prior is not None:
            follows[prior] = e.first
        own = Chain(e.last, e.n, e.v1 & WORD, e.v2 & WORD, e.b)
        if state is not None and state.conv == e.first:
            begin[e.place] = state
            if e.first == e.last:
                own = Chain(e.last, state.n + e.n, *[(getattr(state, f"v{i}") * pow(m, e.n, 1 << 64) + getattr(own, f"v{i}")) & WORD
                                                     for i, m in enumerate(MULTIPLIERS, 1)], state.b + e.b)
        state, prior = own, e.place
    return begin, follows, sum(e.n_rows for e in rows)


def numbered(keys: DataFrame) -> DataFrame:
    """Turn keys with ``pos``, their place in the conversation from 0."""
    dealt = deal(keys, ["conv_id", "at", "k1", "k2"])
    begin, _, _ = carried(dealt)

    def number(frames):
        walker = None
        for f in frames:
            if len(f):
                walker = walker or Walker(begin.get(int(f["_range"].iloc[0])))
                yield f[["conv_id", "k1", "k2", "nb"]].assign(pos=walker.step(f)["count"] - 1)

    return dealt.mapInPandas(number, "conv_id long, k1 long, k2 long, nb long, pos long")


def respliced(keys: DataFrame, every: int = 5, longest: int = 8) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation c - c % every (all if fewer, none
    if absent) and goes on with its own after its first h; h = crc32(decimal c) % (longest + 1). Turn keys with
    ``seq`` (0: the root row that every conversation has, 1: a turn)."""
    rows = settle(numbered(keys))
    base = F.col("conv_id") - F.col("conv_id") % every
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    convs = rows.where("pos = 0").select("conv_id", h.cast("int").alias("h"), base.alias("base"))
    heads = (rows.where((F.col("pos") < longest) & (F.col("conv_id") % every == 0)).groupBy(F.col("conv_id").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "k1", "k2", "nb"))).alias("head")))  # at most ``longest``
    begun = (convs.join(heads, "base").select("conv_id", F.explode(F.slice("head", 1, F.col("h"))).alias("t"))
             .select("conv_id", F.lit(1).alias("seq"), F.col("t.pos").alias("at"), "t.k1", "t.k2", "t.nb"))
    own = rows.where(F.col("pos") >= h).select("conv_id", F.lit(1).alias("seq"), F.col("pos").alias("at"), "k1", "k2", "nb")
    return begun.unionByName(own).unionByName(roots(convs))


def roots(convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return convs.select("conv_id", F.lit(0).alias("seq"), *[zero.alias(c) for c in ("at", "k1", "k2", "nb")])


class Sketch:
    """Count-min sketch of digests: one bit a cell after merging (counted twice or more)."""

    def __init__(self, n: int, max_cells: int = MAX_CELLS):
        self.log2 = min(max(10, (max(n, 1) * CELLS_PER_PREFIX - 1).bit_length()), max_cells.bit_length() - 1)
        self.block = max(8, self.log2 - 10)

    def cells(self, v: np.ndarray) -> np.ndarray:
        return (v >> np.uint64(64 - self.log2)).astype(np.int64)

    def touched(self, begin: dict[int, Chain]):
        """For each row and block of cells, the cells that this task's prefixes fall in (twice if counted more often)."""
        def flush(parts):
            rows = []
            for r in (1, 2):
                cell, times = np.unique(np.concatenate([self.cells(p[r - 1]) for p in parts]), return_counts=True)
                cell = np.repeat(cell, np.minimum(times, 2))
                block = cell >> self.block
                cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                inside = (cell & ((1 << self.block) - 1)).astype(np.uint32)
                rows += [(r, int(block[a]), inside[a:b].tobytes()) for a, b in zip(cut, [*cut[1:], len(cell)], strict=True)]
            return pd.DataFrame(rows, columns=["r", "block", "cells"])

        def run(frames):
            walker, parts, n = None, [], 0
            for f in frames:
                if len(f):
                    walker = walker or Walker(begin.get(int(f["_range"].iloc[0])))
                    x = walker.step(f)
                    deep = x["count"] > 1
                    if deep.any():
                        parts.append((x["v1"][deep], x["v2"][deep]))
                        n += int(deep.sum())
                    if n >= FLUSH:
                        yield flush(parts)
                        parts, n = [], 0
            if n:
                yield flush(parts)

        return run

    def merged(self, frames):
        blocks: dict[tuple[int, int], np.ndarray] = {}
        for f in frames:
            for r, block, cells in zip(f["r"], f["block"], f["cells"], strict=True):
                acc = blocks.setdefault((r, block), np.zeros(1 << self.block, np.uint8))
                at = np.frombuffer(cells, np.uint32)
                np.add.at(acc, at, 1)
                acc[at] = np.minimum(acc[at], 2)
        for (r, block), acc in blocks.items():
            yield pd.DataFrame([(r, block, np.packbits(acc > 1, bitorder="little").tobytes())], columns=["r", "block", "cells"])

    def build(self, dealt: DataFrame, begin: dict[int, Chain]):
        """Bits of both rows (at most 2 * MAX_CELLS), broadcast."""
        schema = "r int, block int, cells binary"
        n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pieces = dealt.mapInPandas(self.touched(begin), schema).repartition(n, "r", "block").mapInPandas(self.merged, schema)
        bits = np.zeros((2, (1 << self.log2) // 8), np.uint8)
        wide = (1 << self.block) // 8
        for p in pieces.toLocalIterator():
            bits[p.r - 1, p.block * wide : (p.block + 1) * wide] = np.frombuffer(p.cells, np.uint8)
        return dealt.sparkSession.sparkContext.broadcast(bits)


ROWS = ("conv_id long, depth long, v1 long, v2 long, p1 long, p2 long, before long, nb long, last boolean, kind int")


def classified(dealt: DataFrame, begin: dict[int, Chain], follows: dict[int, int], sketch: Sketch, bits) -> DataFrame:
    """Each prefix with its digest, its parent's, the bytes before its last turn, and its kind: 0 possibly shared,
    1 the first that is proven to have one member, 2 a longer one."""

    def run(frames):
        table, walker, held = bits.value, None, None

        def judged(f, follower):
            nonlocal walker
            place = int(f["_range"].iloc[0])
            walker = walker or Walker(begin.get(place))
            known = walker.state.proven if walker.state is not None else False
            x = walker.step(f)
            twice = np.ones(len(f), bool)
            for r in (1, 2):
                cell = sketch.cells(x[f"v{r}"])
                twice &= (table[r - 1, cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
            one = ~twice & (x["count"] > 1)
            at = np.arange(len(f))
            proven = (np.maximum.accumulate(np.where(one, at, -1)) >= x["start"]) | (x["first"] & known)
            before = np.concatenate([[known], proven[:-1]]) & ((at > x["start"]) | x["first"])
            walker.state.proven = bool(proven[-1])
            conv = x["conv"]
            follower = follows.get(place) if follower is None else follower
            last = np.concatenate([conv[1:] != conv[:-1], [follower is None or follower != conv[-1]]])
            digests = {k: x[k].view(np.int64) for k in ("v1", "v2", "p1", "p2")}
            return pd.DataFrame({"conv_id": conv, "depth": x["count"] - 1, **digests, "before": x["before"], "nb": x["nb"],
                                 "last": last, "kind": np.where(~proven, 0, np.where(before, 2, 1)).astype(np.int32)})

        for f in frames:
            if len(f):
                if held is not None:
                    yield judged(held, int(f["conv_id"].iloc[0]))
                held = f
        if held is not None:
            yield judged(held, None)

    return dealt.mapInPandas(run, ROWS)


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Inner join on ``keys`` with a table of one row a key; ``hot``: at most HOT_KEYS keys that hold many rows."""
    if hot.isEmpty():
        return rows.join(table, keys)
    hot = settle(hot)
    few = F.broadcast(hot)
    return (rows.join(F.broadcast(table.join(few, keys, "left_semi")), keys)
            .unionByName(rows.join(few, keys, "left_anti").join(table, keys)))


def _pieces(frames):
    key, ids = None, []
    for f in frames:
        for *node, conv in f.itertuples(index=False, name=None):
            if ids and (node != key or len(ids) >= PIECE):
                yield pd.DataFrame([(*key, ids[0], ",".join(map(str, ids)))], columns=[*NODE, "least", "ids"])
                ids = []
            key = node
            ids.append(conv)
    if ids:
        yield pd.DataFrame([(*key, ids[0], ",".join(map(str, ids)))], columns=[*NODE, "least", "ids"])


def _hashed(frames):
    key, state, done = None, None, []
    for f in frames:
        for *node, _, ids in f.itertuples(index=False, name=None):
            if node != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
            done = []
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=[*NODE, "ends_sha256"])


def list_hashes(ended: DataFrame) -> DataFrame:
    """SHA-256 of each node's ended members, in order: joined in pieces, which one task a node reads one by one."""
    n = int(ended.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*NODE, "conv_id"]
    pieces = (ended.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
              .mapInPandas(_pieces, "v1 long, v2 long, depth long, least long, ids string"))
    return (pieces.repartition(n, "v1", "v2").sortWithinPartitions(*NODE, "least")
            .mapInPandas(_hashed, "v1 long, v2 long, depth long, ends_sha256 string"))


def trie(keys: DataFrame, max_cells: int = MAX_CELLS, least_hot: int = LEAST_HOT) -> DataFrame:
    """The nodes of rooted turn keys (conv_id, seq, at, k1, k2, nb): one row a node."""
    dealt = deal(keys, ["conv_id", "seq", "at", "k1", "k2"])
    begin, follows, n = carried(dealt)
    sketch = Sketch(n, max_cells)
    rows = classified(dealt, begin, follows, sketch, sketch.build(dealt, begin))
    asked = settle(rows.where("kind < 2"))
    shared, single = asked.where("kind = 0"), asked.where("kind = 1")
    hot_at = max(least_hot, -(-asked.count() // HOT_KEYS))

    nodes = settle(shared.groupBy(*NODE).agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("before").alias("before"), F.min("p1").alias("p1"),
        F.min("p2").alias("p2"), F.bool_and("last").alias("leaf")))
    start = F.struct("depth", "before", "p1", "p2")
    nothing = F.lit(None)
    # one row a conversation: where its own stretch begins, if it has one, and the bytes before that
    stretch = (nodes.select(F.col("rep").alias("conv_id"), start.alias("s"), "leaf", nothing.cast("long").alias("total"))
               .unionByName(single.select("conv_id", start.alias("s"), F.lit(True).alias("leaf"), nothing.cast("long").alias("total")))
               .unionByName(shared.where("last").select("conv_id", nothing.cast(nodes.select(start.alias("s")).schema["s"].dataType).alias("s"),
                                                        F.lit(False).alias("leaf"), (F.col("before") + F.col("nb")).alias("total")))
               .groupBy("conv_id").agg(F.min("s").alias("s"), F.bool_or("leaf").alias("leaf"), F.max("total").alias("total"))
               .select("conv_id", F.col("s.depth").alias("begins"), "leaf", F.coalesce("s.before", "total").alias("until"),
                       F.col("s.p1").alias("v1"), F.col("s.p2").alias("v2"), (F.col("s.depth") - 1).alias("depth")))
    stretch = settle(stretch)
    parents = nodes.select(*NODE, F.col("rep").alias("parent"))
    under = looked_up(stretch.where("depth >= 0"), parents, NODE, nodes.where(F.col("n") >= hot_at).select(*NODE))
    other = stretch.where("depth is null or depth < 0").withColumn("parent", nothing.cast("long"))
    told = settle(under.unionByName(other).select("conv_id", "begins", "leaf", "until", "parent"))

    busy = asked.groupBy("conv_id").count().where(F.col("count") >= hot_at).select("conv_id")
    parent: Column = F.when(F.col("depth") == F.col("begins"), F.col("parent")).when(F.col("depth") > F.col("begins"), F.col("conv_id"))
    child = (~F.col("last") & F.coalesce(F.col("begins") <= F.col("depth") + 1, F.lit(False))).cast("long")
    summed = (looked_up(shared, told, ["conv_id"], busy).groupBy(*NODE)
              .agg(F.min("conv_id").alias("conv_id"), F.max(parent).alias("parent_conv_id"), F.count(F.lit(1)).alias("n_convs"),
                   F.sum(child).alias("n_children"), F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
                   F.sum(F.greatest(F.col("until") - F.col("before"), F.lit(0))).cast("long").alias("saved_tokens")))
    nobody = hashlib.sha256(b"").hexdigest()
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    met = (summed.join(list_hashes(shared.where("last")), NODE, "left")
           .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nobody))).select(*out))

    def alone(found: DataFrame, above: Column) -> DataFrame:
        one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
        return found.select("conv_id", "depth", above.alias("parent_conv_id"), one.alias("n_convs"),
                            (~F.col("last")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
                            F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
                            .otherwise(nobody).alias("ends_sha256"))

    return (met.unionByName(alone(looked_up(single, told, ["conv_id"], busy), parent))
            .unionByName(alone(rows.where("kind = 2"), F.col("conv_id"))))


def prefix_trie(turns: DataFrame, **names: str) -> DataFrame:
    """The trie of conversations as they are (columns: conv, turn, role, text)."""
    keys = turn_keys(turns, **names)
    return trie(keys.withColumn("seq", F.lit(1)).unionByName(roots(keys.select("conv_id").distinct())))
