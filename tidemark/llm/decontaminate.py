"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document if the document holds ``percent`` or more of the item's distinct 5-word shingles,
wherever they stand. Items are partitioned by size: an item of n shingles keeps a bottom-k MinHash sketch, the k smallest
of its shingle hashes, with k = n - ceil(percent * n) + 1 growing with its partition. A document that contains the item
misses fewer than k of its shingles, so it holds one of the sketch: the search loses nothing. Documents are partitioned
by size too, and a sketch is looked up only among documents long enough for its item. What the sketches find is verified
by exact shingle containment.

Documents shrink before any shuffle: a bitmap of fixed size of the items' hashes, built by a distributed OR, lets only
shingles through that some item may have. Whatever the size of the benchmark, nothing else is broadcast by this module.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, in lower case (A-Z).

Defined results: a null or empty text contains nothing. Items are told apart by row, so one without an id is found too
(``first_item`` is null if no found item has an id), and the rows of one item id are items of their own. An item of fewer than five words is its whole sequence as one
shingle; an item without words is never found. Rows that share an id are judged one by one. With an empty benchmark
every document is clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import released, staged
from tidemark.llm.wordhash import buffer_of, chunks, run_hashes, words_of

SHINGLE, PERCENT = 5, 80
BITMAP_BITS = 24
_BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _each(texts: pd.Series) -> Iterator:
    data, starts = buffer_of(texts)
    for begin, end in chunks(data, starts):
        yield begin, end, words_of(data[starts[begin]: starts[end]], starts[begin: end + 1] - starts[begin], True, _BREAKS)


def _items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for begin, end, words in _each(batch["text"]):
            rows = []
            for i, a, b in zip(range(begin, end), words.first[:-1], words.first[1:]):
                k = min(SHINGLE, b - a)
                own = np.unique(run_hashes(words.hashes[a:b], k)[: b - a - k + 1]) if k else np.zeros(0, np.uint64)
                rows.append((batch["item"].iloc[i], len(own), k, own.view(np.int64)))
            yield pd.DataFrame(rows, columns=["item", "n", "k", "shingles"])


def _hits(bitmap: np.ndarray, lengths: list[int]):
    """Shingles of each document that pass the bitmap, and how many shingles it has at most."""
    mask = np.uint64((1 << BITMAP_BITS) - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin, end, words in _each(batch["text"]):
                n = np.diff(words.first)
                text_of = np.repeat(np.arange(end - begin), n)
                rest = np.repeat(words.first[1:], n) - np.arange(len(words.hashes))
                docs, found = [], []
                for k in lengths:
                    runs = words.runs(k)
                    low = (runs & mask).astype(np.int64)
                    at = np.flatnonzero((bitmap[low >> 3] >> (low & 7).astype(np.uint8) & 1).astype(bool) & (rest >= k))
                    docs.append(text_of[at])
                    found.append(runs[at])
                docs, found = np.concatenate(docs), np.concatenate(found)
                order = np.argsort(docs, kind="stable")
                docs, found = docs[order], found[order]
                edges = np.searchsorted(docs, np.arange(end - begin + 1))
                own = [np.unique(found[a:b]).view(np.int64) for a, b in zip(edges[:-1], edges[1:])]
                tags = [xxhash.xxh3_64_intdigest(words.data[a:b].tobytes()) >> 1
                        for a, b in zip(words.text_starts[:-1], words.text_starts[1:])]
                yield pd.DataFrame({"id": batch["id"].iloc[begin:end].to_numpy(), "tag": tags, "m": n, "shingles": own})
    return run


def shingle_bitmap(items: DataFrame) -> np.ndarray:
    """Bits of all item shingles, 2^BITMAP_BITS of them: OR-ed by the executors, at most 2^18 words reach the driver."""
    low = items.select(F.explode("shingles").alias("h")).select(F.col("h").bitwiseAND((1 << BITMAP_BITS) - 1).alias("low"))
    words = low.groupBy(F.shiftright("low", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(low & 63 AS int))")).alias("bits")).collect()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for row in words:
        out[row["word"]] = row["bits"]
    return out.view(np.uint8)


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Row keys of all documents (id, tag), and the contained items of each (id, tag, item, held, n)."""
    spark = docs.sparkSession
    named = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    items = staged(named.mapInPandas(_items, "item string, n bigint, k int, shingles array<bigint>")
                   .withColumn("item", F.col("item").cast("bigint")).filter("n > 0").withColumn("row", F.monotonically_increasing_id()), "items")
    lengths = sorted(r["k"] for r in items.select("k").distinct().collect())  # five at most
    bitmap = spark.sparkContext.broadcast(shingle_bitmap(items))
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _hits(bitmap.value, lengths or [SHINGLE])(batches)

    held = staged(rows.mapInPandas(released(hits), "id string, tag bigint, m bigint, shingles array<bigint>")
                  .withColumn("id", F.col("id").cast("bigint")), "hits")

    need = F.ceil(F.col("n") * percent / 100).cast("bigint")
    depth = (F.col("n") - need + 1).cast("int")
    unsigned = F.transform("shingles", lambda h: h.bitwiseXOR(F.lit(-(1 << 63))))  # orders like unsigned numbers
    sketch = F.transform(F.slice(F.sort_array(unsigned), 1, depth), lambda h: h.bitwiseXOR(F.lit(-(1 << 63))))
    sketches = items.select("row", need.alias("need"), F.explode(sketch).alias("h"))  # items are told apart by row: ids may be null
    shingles = items.select("row", "n", need.alias("need"), F.explode("shingles").alias("h"))
    owned = held.filter(F.size("shingles") > 0).select("id", "tag", "m", F.explode("shingles").alias("h"))
    # null ids are documents as well: they are told apart by their tag
    key = F.coalesce("id", F.lit(0)), F.col("id").isNull(), F.col("tag")
    owned = owned.distinct().withColumn("doc", F.struct(key[0].alias("id"), key[1].alias("no_id"), key[2].alias("tag")))
    candidates = owned.join(sketches, "h").filter("m >= need").select("doc", "row").distinct()
    # only a candidate's shingles are looked up, so a phrase that many documents and items share makes no pairs of them
    found = (candidates.join(shingles, "row").join(owned.select("doc", "h"), ["doc", "h"])
             .groupBy("doc", "row", "n", "need").agg(F.count("*").alias("held")).filter("held >= need")
             .join(items.select("row", "item"), "row"))
    return held.select("id", "tag"), found.select(
        F.when(~F.col("doc.no_id"), F.col("doc.id")).alias("id"), F.col("doc.tag").alias("tag"), "item", "held", "n")


def mark_documents(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """Per row of ``docs``: id, contaminated, n_items (contained items), first_item (the smallest id, null if none) and
    containment (the largest share of an item's shingles)."""
    rows, found = find_items(docs, benchmark, **columns)
    per = found.groupBy("id", "tag").agg(
        F.count("*").alias("n_items"), F.min("item").alias("first_item"), F.max(F.col("held") / F.col("n")).alias("containment"))
    per = per.select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), "n_items", "first_item", "containment")
    return rows.join(per, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left").select(
        "id", "tag", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "first_item", "containment")
