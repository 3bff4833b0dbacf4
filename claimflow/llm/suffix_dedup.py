"""Removal of repeated byte strings by longest-previous-factor arrays over suffix order.

A byte is removed if a string of ``length`` bytes that covers it starts at another place too (any place
of any document; ``keep="first"``: at an earlier one, documents in id order). In a text's suffix order,
the previous and next suffixes with smaller positions give the longest earlier match of each position
(LPF), those with larger positions the longest later match; a start whose match reaches ``length`` is a
copy. One suffix array of everything would be one task's work, so starts that could match are brought
together first:

1. Every window of ``length`` bytes has an anchor, the least hash among its ``GRAM``-byte grams (the
   leftmost of equals). Equal windows have equal grams at equal places, so the same anchor at the same
   offset. Windows in a row that share an anchor occurrence are one record: the anchor's hash and a
   hash of all bytes they cover. There is one record for some 180 bytes.
2. Records that agree in both hashes are copies as a whole: their windows are done, and one of them goes
   on in their place. Anchors whose records all agree, or that stand alone, need nothing more.
3. Where records of an anchor differ, their bytes are fetched. A task takes whole anchors: windows whose
   rolling hash does not recur there have no match; suffix order and LPF arrays over the rest decide,
   byte for byte. An anchor with more than ``SPLIT`` different records is dealt out by a hash of its
   windows' first bytes, so equal windows still meet and no task holds all of a frequent passage.

Matches never cross documents. Defined results: null and empty texts have zero bytes and nothing removed;
a text shorter than ``length`` is kept; rows that repeat an id and a text are copies of each other; texts
are read whole; an empty table gives no rows. Other columns are left unread.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.common import broadcast_within, settle
from claimflow.llm.text_bytes import mix, powers, prefix_hash, to_bytes

LENGTH = 400
GRAM = 32
SPLIT = 16_384
HEAD = 24
CHUNK = 1 << 18
BATCH_BYTES = 4 << 20
SUFFIX_BYTES = 1 << 19
MAX_BROADCAST_RECORDS = 1_000_000  # of some 40 bytes


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Records of a text: first window, number of windows, the anchor's offset in the first, its hash,
    and the hash of all bytes that the windows cover."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums, back = prefix_hash(data), powers(len(data) + 1, "down")
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * back[: len(data) - GRAM + 1])
    width = length - GRAM + 1
    place = np.empty(n, np.int64)
    for at in range(0, n, CHUNK):  # hash above, place below: the least is the leftmost of the least
        part = gram[at : min(at + CHUNK, n) + width - 1]
        low = (part & ~np.uint64(0xFFFFF)) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < width:
            low = np.minimum(low[: -(width - size)], low[width - size :])
        place[at : at + CHUNK] = (low & np.uint64(0xFFFFF)).astype(np.int64) + at
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    count = np.diff(np.concatenate([first, [n]]))
    anchor = place[first]
    end = first + count - 1 + length
    whole = (sums[end] - sums[first]) * back[first]
    whole = mix(whole + (anchor - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + count.astype(np.uint64)
    return first, count, anchor - first, gram[anchor], mix(whole)


def dense(keys: np.ndarray) -> np.ndarray:
    """Ranks 1, 2, ... of the keys, equal for equal keys."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    rank = np.empty(len(keys), np.int64)
    if len(keys):
        rank[order] = 1 + np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return rank


class SuffixOrder:
    """Suffix order of several segments of one byte string, up to ``cap`` bytes (ties: by position).
    A suffix ends with its segment; segments of different groups have no common prefix."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, groups: np.ndarray, cap: int):
        n = len(data)
        self.lengths = np.diff(np.concatenate([starts, [n]]))
        self.left = np.repeat(starts + self.lengths, self.lengths) - np.arange(n)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        key = np.zeros(n, np.uint64)
        for j in range(8):
            byte = padded[j : j + n].astype(np.uint64)
            key = (key << np.uint64(8)) | np.where(self.left > j, byte, np.uint64(0))
        self.key = key
        short = np.minimum(self.left, 8)
        rank = dense(dense(key) * 9 + short)
        self.group = np.repeat(groups, self.lengths)
        rank = dense(self.group * np.int64(n + 1) + rank)
        self.levels, size = [(8, rank)], 8
        while size < cap and rank.max(initial=0) < n:
            after = np.zeros(n, np.int64)
            more = np.flatnonzero(self.left > size)
            after[more] = rank[more + size]
            rank = dense(rank * np.int64(n + 1) + after)
            size *= 2
            self.levels.append((size, rank))
        self.order = np.argsort(rank, kind="stable")

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b (by ranks of 2**k bytes, then by bytes)."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        live = np.ones(len(a), bool)
        for size, rank in reversed(self.levels):
            same = np.flatnonzero(live & (np.minimum(self.left[a], self.left[b]) >= size))
            same = same[rank[a[same]] == rank[b[same]]]
            out[same] += size
            end = (self.left[a[same]] == size) | (self.left[b[same]] == size)
            live[same[end]] = False
            a[same[~end]] += size
            b[same[~end]] += size
        differ, last = self.key[a] ^ self.key[b], np.minimum(self.left[a], self.left[b])
        equal = np.full(len(a), 8, np.int64)
        for j in range(7, -1, -1):
            equal[((differ >> np.uint64(56 - 8 * j)) & np.uint64(0xFF)) != 0] = j
        return out + np.where(live, np.minimum(equal, last), 0)

    def longest(self, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(LPF, LNF): for each position the longest match at a smaller and at a larger position, by the
        nearest suffixes before and after it in suffix order whose position is smaller (larger). Matches
        below ``least`` count as 0."""
        n = len(self.order)
        near = np.zeros(n + 1, np.int64)  # near[i]: common prefix of the suffixes i - 1 and i of the order
        if n > 1:
            near[1:n] = self.common(self.order[:-1], self.order[1:])
            group = self.group[self.order]
            near[1:n][group[1:] != group[:-1]] = 0
        out = []
        for sign in (1, -1):
            best = np.zeros(n, np.int64)
            for step in (-1, 1):
                match = self._nearest(sign * self.order, near, step, least)
                best[self.order] = np.maximum(best[self.order], match)
            out.append(best)
        return out[0], out[1]

    @staticmethod
    def _nearest(position: np.ndarray, near: np.ndarray, step: int, least: int) -> np.ndarray:
        """For each place of the order, the common prefix with the nearest place on one side whose position
        is smaller. Places jump over those that a neighbour has passed already, all at once."""
        n = len(position)
        at = np.arange(n)
        to = at + step
        match = (near[:n] if step < 0 else near[1 : n + 1]).copy()
        match[match < least] = 0
        if step < 0 and n:
            match[0] = 0
        open_ = np.flatnonzero(match > 0)
        open_ = open_[position[to[open_]] > position[open_]]
        while len(open_):
            via = to[open_]
            new = np.minimum(match[open_], match[via])
            target = to[via]
            ended = (new < least) | (target < 0) | (target >= n)
            match[open_] = np.where(ended, 0, new)
            to[open_] = target
            open_ = open_[~ended]
            open_ = open_[position[to[open_]] > position[open_]]
        return match


def copied(pieces: list[np.ndarray], groups: np.ndarray, length: int, first: bool) -> list[np.ndarray]:
    """For each piece of bytes, in order of place, which of its windows start elsewhere in its group too
    (``first``: earlier in its group)."""
    out = [np.zeros(max(0, len(p) - length + 1), bool) for p in pieces]
    hashes, owner = [], []
    for i, p in enumerate(pieces):
        if len(out[i]):
            sums = prefix_hash(p)
            hashes.append(mix((sums[length:] - sums[:-length]) * powers(len(p) + 1, "down")[: len(out[i])]
                              + np.uint64(int(groups[i]) % 2**64) * np.uint64(0xD6E8FEB86659FD93)))
            owner.append(i)
    if not hashes:
        return out
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    again = np.zeros(len(every), bool)
    same = ordered[1:] == ordered[:-1]
    again[order[1:]] = same
    again[order[:-1]] |= same
    at = 0
    runs = []  # (piece, first window, last window) whose hashes recur
    for i, h in zip(owner, hashes, strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], again[at : at + len(h)].astype(np.int8), [0]])))
        runs += [(i, s, e - 1) for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
        at += len(h)
    at = 0
    while at < len(runs):  # whole groups, some SUFFIX_BYTES at a time
        to, size = at, 0
        while to < len(runs) and (size < SUFFIX_BYTES or groups[runs[to][0]] == groups[runs[to - 1][0]]):
            size += runs[to][2] - runs[to][1] + length
            to += 1
        part = runs[at:to]
        texts = [pieces[i][s : e + length] for i, s, e in part]
        starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
        numbers = dense(np.array([groups[i] for i, _, _ in part], np.int64))
        lpf, lnf = SuffixOrder(np.concatenate(texts), starts, numbers, length).longest(length)
        hit = lpf >= length if first else np.maximum(lpf, lnf) >= length
        for (i, s, e), b in zip(part, starts.tolist(), strict=True):
            out[i][s : e + 1] |= hit[b : b + e - s + 1]
        at = to
    return out


def _records(kind: str, length: int):
    def run(batches):
        for b in batches:
            rows = []
            for i, t, text in zip(b["id"], b["t"], b["x"], strict=True):
                s, n, lead, fp, whole = anchors(to_bytes(text), length)
                if len(s):
                    rows.append(pd.DataFrame({"id": pd.Series([i] * len(s), dtype=b["id"].dtype), "t": t, "s": s, "n": n, "lead": lead,
                                              "fp": fp.view(np.int64), "whole": whole.view(np.int64)}))
            if rows:
                yield pd.concat(rows, ignore_index=True)

    return run, f"id {kind}, t long, s int, n int, lead int, fp long, whole long"


def _pieces(kind: str, length: int, split: int):
    """The bytes of asked records, once for each part of a frequent anchor that has windows of theirs."""
    def run(batches):
        for b in batches:
            rows = []
            for i, t, text, asked in zip(b["id"], b["t"], b["x"], b["asked"], strict=True):
                data = to_bytes(text)
                for r in asked:
                    piece = data[r["s"] : r["s"] + r["n"] - 1 + length]
                    parts = -(-r["variants"] // split)
                    which = [0] if parts == 1 else np.unique(_heads(piece, length) % np.uint64(parts)).tolist()
                    raw = piece.tobytes()
                    rows += [(r["fp"], int(p), parts, i, t, r["s"], raw) for p in which]
                    if len(rows) >= 2000:
                        yield _frame(rows, b["id"].dtype)
                        rows = []
            if rows:
                yield _frame(rows, b["id"].dtype)

    return run, f"fp long, part int, parts int, id {kind}, t long, s int, piece binary"


def _frame(rows, dtype):
    out = pd.DataFrame(rows, columns=["fp", "part", "parts", "id", "t", "s", "piece"])
    out["id"] = out["id"].astype(dtype)
    return out


def _heads(piece: np.ndarray, length: int) -> np.ndarray:
    """A hash of the first HEAD bytes of each window of the piece."""
    n = len(piece) - length + 1
    sums = prefix_hash(piece)
    return mix((sums[HEAD : HEAD + n] - sums[:n]) * powers(len(piece) + 1, "down")[:n])


def _decide(kind: str, length: int, first: bool):
    """Spans of copied windows from pieces sorted by (fp, part, id, t, s); whole buckets at a time."""
    def decide(b):
        pieces = [np.frombuffer(x, np.uint8) for x in b["piece"]]
        groups = dense(dense(b["fp"].to_numpy()) * np.int64(2**20) + b["part"].to_numpy())
        rows = []
        for n, flags in enumerate(copied(pieces, groups, length, first)):
            if b["parts"].iat[n] > 1 and flags.any():  # windows of other parts were met by chance only
                flags = flags & (_heads(pieces[n], length) % np.uint64(b["parts"].iat[n]) == np.uint64(b["part"].iat[n]))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
            at = int(b["s"].iat[n])
            rows += [(b["id"].iat[n], b["t"].iat[n], at + s, at + e - 1 + length)
                     for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
        out = pd.DataFrame(rows, columns=["id", "t", "s", "e"])
        out["id"] = out["id"].astype(b["id"].dtype)
        return out

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b["piece"].str.len().sum()
            if size < BATCH_BYTES:
                continue
            every = pd.concat(held, ignore_index=True)
            last = (every["fp"] == every["fp"].iat[-1]) & (every["part"] == every["part"].iat[-1])
            cut = int(np.argmax(last.to_numpy()))
            if cut:
                yield decide(every.iloc[:cut].reset_index(drop=True))
            held, size = [every.iloc[cut:]], every["piece"].iloc[cut:].str.len().sum()
        if held:
            every = pd.concat(held, ignore_index=True)
            if len(every):
                yield decide(every)

    return run, f"id {kind}, t long, s int, e int"


def _same(a: str, b: str):
    return F.expr(f"{a}.id <=> {b}.id and {a}.t = {b}.t")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   keep: str = "none", split: int = SPLIT) -> DataFrame:
    """(id, t, runs): for each document with repeated strings, the maximal runs (s, e) of their bytes.
    t is the hash of the text. keep: "none" removes every copy, "first" all but the first."""
    if length < GRAM or keep not in ("none", "first"):
        raise ValueError(f"length must be {GRAM} or more, keep 'none' or 'first'")
    kind = docs.schema[id_col].dataType.simpleString()
    named = _named(docs, id_col, text_col)
    run, schema = _records(kind, length)
    records = settle(named.mapInPandas(run, schema))
    agree = records.groupBy("fp", "whole").agg(F.count(F.lit(1)).alias("agreeing"), F.min(F.struct("id", "t", "s")).alias("rep"))
    agree = settle(agree.join(agree.groupBy("fp").agg(F.count(F.lit(1)).alias("variants"), F.sum("agreeing").alias("all"))
                              .where("all > 1").select("fp", "variants"), "fp"))
    shared = records.join(agree, ["fp", "whole"]).withColumn("is_rep", F.struct("id", "t", "s") == F.col("rep"))
    shared = settle(shared.select("id", "t", "s", "n", "fp", "agreeing", "variants",
                                  F.coalesce("is_rep", F.expr("rep.id is null and id is null and rep.t = t and rep.s = s")).alias("is_rep")))
    done = shared.where("agreeing > 1" if keep == "none" else "agreeing > 1 and not is_rep")
    done = done.select("id", "t", "s", (F.col("s") + F.col("n") - 1 + length).alias("e"))
    asked = (shared.where("variants > 1 and is_rep").groupBy("id", "t")
             .agg(F.array_distinct(F.collect_list(F.struct("s", "n", "fp", "variants"))).alias("asked")))
    asked = settle(asked)
    run, schema = _pieces(kind, length, split)
    pieces = (named.alias("d").join(broadcast_within(asked, MAX_BROADCAST_RECORDS, F.size("asked")).alias("a"), _same("d", "a"))
              .select("d.id", "d.t", "d.x", "a.asked").mapInPandas(run, schema))
    order = ["fp", "part", "id", "t", "s"]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run, schema = _decide(kind, length, keep == "first")
    met = (pieces.select(*order, "parts", "piece").repartition(n, "fp", "part")
           .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order]).mapInPandas(run, schema))
    spans = done.unionByName(met).distinct()
    text = Window.partitionBy("id", "t")
    so_far = text.orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    joined = (spans.withColumn("new", (F.col("s") > F.coalesce(F.max("e").over(so_far), F.lit(-1))).cast("int"))
              .withColumn("run", F.sum("new").over(text.orderBy("s", "e")))
              .groupBy("id", "t", "run").agg(F.min("s").alias("s"), F.max("e").alias("e")))
    return joined.groupBy("id", "t").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("runs"))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    x = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(x).alias("t"), x.alias("x"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   keep: str = "none", split: int = SPLIT) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, runs (maximal removed runs), kept (the other
    bytes, joined) and kept_sha256."""
    kind = docs.schema[id_col].dataType.simpleString()
    runs = settle(repeated_spans(docs, id_col, text_col, length, keep, split))

    def run(batches):
        for b in batches:
            kept = []
            for text, spans in zip(b["x"], b["runs"], strict=True):
                raw, at, parts = (text or "").encode("utf-8", "surrogatepass"), 0, []
                for r in spans if spans is not None else ():
                    parts.append(raw[at : r["s"]])
                    at = r["e"]
                kept.append((len(raw), b"".join([*parts, raw[at:]])))
            yield pd.DataFrame({
                "id": b["id"], "n_bytes": [n for n, _ in kept], "n_removed": [n - len(k) for n, k in kept],
                "runs": [[(r["s"], r["e"]) for r in spans] if spans is not None else [] for spans in b["runs"]],
                "kept": [k for _, k in kept], "kept_sha256": [hashlib.sha256(k).hexdigest() for _, k in kept]})

    named = _named(docs, id_col, text_col)
    return (named.alias("d").join(broadcast_within(runs, MAX_BROADCAST_RECORDS, F.size("runs")).alias("r"), _same("d", "r"), "left")
            .select("d.id", "d.x", "r.runs")
            .mapInPandas(run, f"id {kind}, n_bytes long, n_removed long, runs array<struct<s:int,e:int>>, kept binary, "
                              "kept_sha256 string").withColumnRenamed("id", id_col))
