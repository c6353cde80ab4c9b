"""Bound-certified best-fit packing of token pieces into sequences of fixed length.

Pieces are dealt at random, by a number of their own, to partitions of bounded size; each packs its own by best-fit decreasing and computes a lower
bound on its sequences by dual feasible functions. A partition that meets its bound is certified optimal. One that does
not tries a second order, which fills sequences one at a time and exactly where it can, and keeps the better packing.

While the partitions together have more sequences than the bound of the whole corpus (which needs only the number of
pieces of each length), they exchange: each gives up the documents of its emptiest sequences, a few for each sequence
over its bound and a few for its last, never quite full ones. Those are dealt to far fewer common partitions, so that
documents of different partitions meet, and packed again. A round that saves nothing ends the exchange.

Defined results: a null or empty text is its end token alone. Rows are never merged: equal documents, or documents with
the same or no id, are packed one by one and spread over the partitions like any others. A text of any length is cut into
pieces. Pieces of one length are taken in the order in which their partition holds them. An empty table gives no rows.
Only the named id and text columns are read, whatever else a table has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.encoder import drop_encoder, encoder_for
from tidemark.llm.tables import released, staged

CAPACITY, END_ID = 1024, 2
GROUP_PIECES = 50_000
RELEASE = 12
_PACKED = "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint, row bigint, grp bigint, bin bigint, offset bigint, released boolean"


def piece_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document; all but the first are full."""
    first = total % capacity or min(total, capacity)
    return [first] + [capacity] * ((total - first) // capacity)


def _pieces(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_for(path)
        for batch in batches:
            for begin, end, ids, where, _ in encoder.each(batch["text"]):
                rows = []
                for i in range(begin, end):
                    own = np.append(ids[where[i - begin]: where[i - begin + 1]], np.int32(end_id)).astype("<u4")
                    at, doc = 0, batch["doc_id"].iloc[i]
                    for number, length in enumerate(piece_lengths(len(own), capacity)):
                        part = own[at: at + length]
                        rows.append((doc, number, at, length, zlib.crc32(part.tobytes()))
                                    + ((part.astype(np.int32),) if keep_ids else ()))
                        at += length
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)
        drop_encoder(path)  # vocabulary and pieces stay known within a task only
    return run


def cut_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
               end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    schema = "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(released(_pieces(tokenizer, capacity, end_id, keep_ids)), schema).withColumn(
        "doc_id", F.col("doc_id").cast("bigint"))  # as text on the way: pandas has no integers with nulls


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences needed at least for ``counts[x]`` pieces of each length x, by two families of dual feasible functions."""
    x = np.arange(capacity + 1, dtype=np.int64)
    n = counts.astype(np.int64)
    best = -(-int((n * x).sum()) // capacity)
    above = np.append(np.cumsum(n[::-1])[::-1], 0)
    volume = np.append(np.cumsum(n * x), 0)
    for least in range(1, capacity // 2 + 1):  # pieces under ``least`` vanish, those over capacity - least fill a sequence
        large = above[capacity - least + 1]
        middle = volume[capacity - least] - volume[least - 1]
        best = max(best, int(large) - (-int(middle) // capacity))
    for k in range(1, 21):
        scaled = (k + 1) * x
        worth = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)  # times capacity * k
        best = max(best, -(-int((n * worth).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and the fill of each sequence."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_mask, fill = 0, []  # bit r: some sequence has r tokens of room
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = open_mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                open_mask ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        if left := room - size:
            free[left].append(b)
            open_mask |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def completing_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``best_fit_decreasing``, one sequence at a time: the longest piece left opens it, and the room is filled
    exactly by one or two pieces where that can be, otherwise by the longest that fits and so on."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    by_length = np.argsort(lengths, kind="stable")
    ends = np.cumsum(counts)
    bins, offsets, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    used, longest = 0, capacity

    def take(length: int, room: int) -> int:
        nonlocal used
        i = by_length[ends[length] - counts[length]]
        counts[length] -= 1
        used += 1
        bins[i], offsets[i] = len(fill), capacity - room
        return room - length

    while used < len(lengths):
        while not counts[longest]:
            longest -= 1
        room = take(longest, capacity)
        while room:
            if counts[room]:
                room = take(room, room)
                break
            fitting = np.flatnonzero(counts[1: room + 1]) + 1
            if not len(fitting):
                break
            pairs = fitting[(counts[room - fitting] > 0) & ((2 * fitting != room) | (counts[fitting] > 1)) & (fitting < room)]
            if len(pairs):
                room = take(int(pairs[-1]), room)
                room = take(room, room)
                break
            room = take(int(fitting[-1]), room)
        fill.append(capacity - room)
    return bins, offsets, np.array(fill, np.int64)


def _pack(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        if len(fill) > bound:
            other = completing_fit(lengths, capacity)
            if len(other[2]) < len(fill):
                bins, offsets, fill = other
        gap = len(fill) - bound
        # one sequence of any partition is as good as never full, so even a certified one has its emptiest to offer
        emptiest = np.argsort(fill, kind="stable")[: RELEASE * max(gap, 1)]
        released = np.zeros(len(fill), bool)
        released[emptiest[fill[emptiest] < capacity]] = True
        return group.assign(bin=bins, offset=offsets, released=released[bins])
    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Sequence id and offset of each piece of ``cut_pieces``; see the module."""
    pieces = staged(pieces.select("doc_id", "piece", "start", "length", "ids_crc32",
                                  F.monotonically_increasing_id().alias("row")), "pieces")  # written, so that numbers stay
    histogram = pieces.groupBy("length").count().collect()  # one row per length, capacity at most
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    bound = lower_bound(counts, capacity)

    used = 0  # groups so far: those of a later turn are numbered on, and so are their sequences

    def packed(rows: DataFrame, n: int) -> DataFrame:
        nonlocal used
        groups = max(1, -(-n // group_pieces))
        # equal pieces differ in their row, and those that met once are dealt anew
        dealt = rows.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(used)), F.lit(groups)) + used)
        used += groups
        dealt = dealt.withColumn("doc_id", F.col("doc_id").cast("string"))
        return staged(dealt.groupBy("grp").applyInPandas(_pack(capacity), _PACKED)
                      .withColumn("doc_id", F.col("doc_id").cast("bigint")), "packed")

    def sizes(rows: DataFrame) -> tuple[int, int, int]:
        """Sequences, released sequences and released pieces."""
        per = rows.groupBy("grp").agg(F.max("bin").alias("last"), F.count_if("released").alias("pieces"),
                                      F.count_if(F.col("released") & (F.col("offset") == 0)).alias("bins"))
        row = per.agg(F.sum(F.col("last") + 1), F.sum("bins"), F.sum("pieces")).first()
        return row[0] or 0, row[1] or 0, row[2] or 0

    done = []
    latest = packed(pieces, int(counts.sum()))
    total, out, n_out = sizes(latest)
    while out and total > bound:
        again = packed(latest.filter("released").select(pieces.columns), n_out)
        made, out_next, n_next = sizes(again)
        if made >= out:
            break
        done.append(latest.filter("NOT released"))
        total += made - out
        latest, out, n_out = again, out_next, n_next
    done.append(latest)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    # sequences of a group are dense from 0 and below 2^32; groups of all turns are below 2^31
    sequence = F.shiftleft("grp", 32) + F.col("bin")
    return result.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, **columns: str) -> DataFrame:
    return pack_pieces(cut_pieces(docs, tokenizer, **columns))
