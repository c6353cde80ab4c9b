"""Substring deduplication by seed and extend.

Every text is winnowed: of each run of ``window - seed + 1`` consecutive ``seed``-word hashes the smallest is an anchor,
so any repeat of ``window`` words holds one and the same anchor wherever it occurs. Documents are joined on anchors
(seeds) that two documents share. Each seed is extended both ways: every window of ``window`` words that still covers it
is looked up under its owner, the document with the smallest id in which that window starts. Found windows that touch
chain into maximal repeats, which are the spans to remove. Owners are minima, so nothing is ever paired within a group
of copies, and partial aggregation shrinks a passage that millions of documents share before it is shuffled.

Exact copies are settled first, by the SHA-256 of their words: a copy of a document with a smaller id loses every word
(if it has ``window`` words at all), and adds no window that its original has not.

Defined results: a null or empty text has no words and loses none. Rows without an id own nothing and lose nothing.
Rows that share an id belong to one document, so they never remove words from each other. Window hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import discard, released, staged
from tidemark.llm.wordhash import each_words, run_hashes

WINDOW, SEED = 50, 16
_FACTS = "id string, n_words bigint, sha binary, tag int, anchors array<bigint>, anchor_at array<int>"
_OPENED = "id bigint, tag int, text string, starts array<int>, hashes array<bigint>"
_SPANS = "id bigint, tag int, n_removed bigint, kept string, spans array<struct<begin:int,end:int>>"


def sha_of_words(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def tag_of(sha: bytes) -> int:
    """Tells the few texts of one id apart in fewer bytes."""
    return int.from_bytes(sha[:4], "little", signed=True)


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the smallest hash of some ``width`` consecutive ones (the last of equal ones)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    # minima of each block's prefixes and suffixes: any window is a suffix of one block and a prefix of the next
    blocks = -(-len(hashes) // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(hashes)] = hashes
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[width - 1: width - 1 + n])
    order = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    # a new minimum begins at ``order``; it lies in that window, and equal hashes are one anchor value
    found = [int(i) + int(np.flatnonzero(hashes[i: i + width] == least[i])[-1]) for i in order]
    # while a minimum stays the smallest, a later equal occurrence must be an anchor too
    repeat = np.flatnonzero(hashes[width:] == least[:-1]) + width if n > 1 else np.zeros(0, np.int64)
    return np.unique(np.concatenate([np.array(found, np.int64), repeat]))


def _facts(window: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"]
            for begin, end, words in each_words(texts):
                anchors, places = [], []
                runs = words.runs(seed)
                for a, b in zip(words.first[:-1], words.first[1:]):
                    own = runs[a: b - seed + 1] if b - a >= window else runs[:0]
                    at = winnow(own, window - seed + 1)
                    anchors.append(own[at].view(np.int64))
                    places.append(at.astype(np.int32))
                split = [(t or "").encode().split() for t in texts.iloc[begin:end]]
                shas = [sha_of_words(w) for w in split]
                yield pd.DataFrame({
                    "id": batch["id"].iloc[begin:end].array, "n_words": np.diff(words.first), "sha": shas,
                    "tag": [tag_of(x) for x in shas], "anchors": anchors, "anchor_at": places})
    return run


def _open(window: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, (_, _, words) in enumerate(each_words(batch["text"], limit=0)):
                row = batch.iloc[i]
                if tag_of(sha_of_words((row["text"] or "").encode().split())) != row["tag"]:
                    continue  # another row with the same id
                n = len(words.hashes)
                at = np.asarray(row["seeds"], np.int64)
                mark = np.zeros(n + 1, np.int64)
                np.add.at(mark, np.maximum(at + seed - window, 0), 1)
                np.add.at(mark, np.minimum(at, n - window) + 1, -1)
                starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
                runs = run_hashes(words.hashes, window)[starts]
                yield pd.DataFrame({"id": [row["id"]], "tag": [row["tag"]], "text": [row["text"]],
                                    "starts": [starts.astype(np.int32)], "hashes": [runs.view(np.int64)]})
    return run


def spans_of(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal word ranges covered by windows that begin at ``starts``."""
    at = np.sort(np.asarray(starts, np.int64))
    if not len(at):
        return []
    breaks = np.flatnonzero(at[1:] > at[:-1] + window)
    begins = at[np.append(0, breaks + 1)]
    ends = at[np.append(breaks, len(at) - 1)] + window
    return list(zip(begins.tolist(), ends.tolist()))


def _cut(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                words = row.text.encode().split()
                spans, kept, at = spans_of(row.found, window), [], 0
                for begin, end in spans:
                    kept += words[at:begin]
                    at = end
                kept += words[at:]
                rows.append((row.id, row.tag, len(words) - len(kept), b" ".join(kept).decode(), spans))
            yield pd.DataFrame(rows, columns=["id", "tag", "n_removed", "kept", "spans"])
    return run


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by one space; null if
    none was removed), ``spans`` (removed maximal word ranges) and ``sha`` of the original words.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    named = docs.withColumn("id", F.col("id").cast("string"))  # pandas has no integers with nulls
    facts = staged(named.mapInPandas(released(_facts(window, seed)), _FACTS).withColumn("id", F.col("id").cast("bigint")), "winnowed")
    # joins on keys that may be hot take staged tables: only plain shuffles can be split by AQE
    first = staged(facts.filter("id IS NOT NULL").groupBy("sha").agg(F.min("id").alias("first_id")), "first")
    placed = facts.select("id", "sha", "tag", "n_words").join(first, "sha", "left")
    copies = placed.filter(F.col("id") > F.col("first_id")).select("id", "tag").distinct()

    anchors = (facts.filter(f"id IS NOT NULL AND n_words >= {window}")
               .join(copies, ["id", "tag"], "left_anti")
               .select("id", "tag", F.explode(F.arrays_zip("anchors", "anchor_at")).alias("a"))
               .select("id", "tag", F.col("a.anchors").alias("anchor"), F.col("a.anchor_at").alias("at")))
    shared = staged(anchors.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"))
                    .filter("low < high").select("anchor"), "shared")
    seeds = anchors.join(shared, "anchor").groupBy("id", "tag").agg(F.collect_list("at").alias("seeds"))
    opened = staged(docs.filter("id IS NOT NULL").join(seeds, "id").mapInPandas(released(_open(window, seed)), _OPENED), "opened")
    discard(shared)

    windows = opened.select("id", "tag", F.explode(F.arrays_zip("starts", "hashes")).alias("w")).select(
        "id", "tag", F.col("w.starts").alias("start"), F.col("w.hashes").alias("hash"))
    owners = staged(windows.groupBy("hash").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
                    .filter("owner < last").select("hash", "owner"), "owners")
    found = (windows.join(owners, "hash").filter("owner < id")
             .groupBy("id", "tag").agg(F.collect_set("start").alias("found")))
    cut = (opened.select("id", "tag", "text").dropDuplicates(["id", "tag"]).join(found, ["id", "tag"])
           .mapInPandas(released(_cut(window)), _SPANS))

    whole = F.array(F.struct(F.lit(0).alias("begin"), F.col("n_words").cast("int").alias("end")))
    is_copy = (F.col("id") > F.col("first_id")) & (F.col("n_words") >= window)
    return placed.join(cut, ["id", "tag"], "left").select(
        "id", "n_words",
        F.when(is_copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(is_copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(is_copy, whole).otherwise(F.coalesce("spans", F.array())).alias("spans"), "sha")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with all its columns, repeats cut from the text: a text that loses words becomes its kept words joined
    by one space, any other stays as it is. Rows are kept even if nothing is left of their text.
    """
    changed = (find_repeats(docs, id_col, text_col, window).filter("n_removed > 0")
               .groupBy(F.col("id").alias("changed_id")).agg(F.collect_set(F.struct("sha", "kept")).alias("changed")))
    row = docs.select(F.struct("*").alias("row"))  # keeps the columns of docs apart from those of the join
    text = F.col("row")[text_col]
    words = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    sha = F.unhex(F.sha2(words, 256))  # tells rows with one id apart; worked out only where the id lost words
    kept = F.when(F.col("changed_id").isNotNull(), F.get(F.filter("changed", lambda c: c["sha"] == sha), F.lit(0))["kept"])
    return (row.join(changed, F.col("row")[id_col].cast("bigint") == F.col("changed_id"), "left")
            .select(*[(F.coalesce(kept, text) if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]))
