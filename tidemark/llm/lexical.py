r"""Ranked lexical search by pair-bound MaxScore: the best documents of each item of a query set.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z in lower case. With N
documents that hold a term, L terms in all, n terms in a document and df documents that hold a term, the term weighs
``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, a document has ``m = 50 + 50 n N div L``, and each of the item's terms that
it holds tf times adds the impact ``w * (10^9 tf div (1000 tf + 20 m))``.

1. *Index.* One pass over whole texts writes blocks of documents: postings (term, document, tf) of the terms that some
   item may hold (a bitmap of fixed size decides; what passes by chance does no harm), with each document's length. df, N
   and L are sums over the blocks.
2. *Impacts and pair lists.* Each block gets its impacts, the largest impact of every term, and for pairs of terms, those
   that are neighbours in an item by weight, the largest joint impact in the intersection of their lists. Partial scores
   of an item's heaviest terms, one maximum for each of ``BUCKETS`` groups of documents, give a score that ``top``
   documents surely reach.
3. *Search.* In each block the units of an item (pairs, single terms) are ordered by bound. A pair's bound is its joint
   maximum or the larger single one, which is tighter than the sum of both; units whose bounds together stay below the
   threshold are not traversed, documents come from the others, and only documents that can still reach the threshold are
   looked up in the rest. Tasks carry thresholds from block to block and send ``top`` rows an item at most.

Every document is indexed and every item searched; the result is that of scoring all of them. Items are taken in sets of
``QUERY_TERMS`` terms, so what is broadcast and what the driver holds is bounded. Texts are never shuffled. Terms are told
apart by 64-bit hashes.

Defined results: null and empty texts, and items without terms, find nothing. Very long texts are whole documents, held in
one task's memory. Rows sharing an id are documents, or items, of their own; a null document id ranks behind the others
of its score, a null item id is an item as any other. Equal scores rank by id. Empty tables give no rows. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.decontaminate import BITMAP_BITS, shingle_bitmap
from tidemark.llm.tables import staged
from tidemark.llm.wordhash import buffer_of, chunks, words_of

TOP = 50
BLOCK_DOCS, BLOCK_POSTINGS = 4_096, 1 << 20
QUERY_TERMS = 200_000
BUCKETS, SEED_TERMS = 64, 6
_BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_RAW = "ids array<bigint>, n array<bigint>, n_docs bigint, n_terms bigint, terms array<bigint>, df array<int>, at array<int>, tf array<int>"
_SCORED = ("ids array<bigint>, t array<int>, df array<int>, at array<int>, impact array<bigint>, most array<bigint>, "
           "pair array<int>, joint array<bigint>, seeds array<bigint>")


def _each(texts: pa.Array) -> Iterator:
    data, starts = buffer_of(texts)
    for begin, end in chunks(data, starts):
        yield begin, end, words_of(data[starts[begin]: starts[end]], starts[begin: end + 1] - starts[begin], True, _BREAKS)


def _lists(kinds: str, columns: list) -> pa.RecordBatch:
    """One row; ``columns`` in the order of the schema ``kinds``, arrays as one list each."""
    names = [c.split()[0] for c in kinds.split(", ")]
    types = [{"array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "bigint": pa.int64()}[c.split()[1]]
             for c in kinds.split(", ")]
    cells = []
    for value, kind in zip(columns, types):
        if value is None or not pa.types.is_list(kind):
            cells.append(pa.array([value], kind))
        else:
            own = value if isinstance(value, pa.Array) else pa.array(value, kind.value_type)
            cells.append(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own))
    return pa.RecordBatch.from_arrays(cells, names)


def query_terms(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, terms (hashes, each once) and a row number q of every item that has terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, words in _each(batch.column("text")):
                own = [np.unique(words.hashes[a:b]).view(np.int64) for a, b in zip(words.first[:-1], words.first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(begin, end - begin), pa.array(own, pa.list_(pa.int64()))],
                                                 ["item_id", "terms"])

    rows = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"item_id {kind}, terms array<bigint>").filter(F.size("terms") > 0)
    return staged(found.withColumn("q", F.monotonically_increasing_id()), "items")


def build_index(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of documents with the postings of the items' terms, sorted by term and document."""
    bitmap = docs.sparkSession.sparkContext.broadcast(shingle_bitmap(items.select(F.col("terms").alias("shingles"))))
    mask = np.uint64((1 << BITMAP_BITS) - 1)

    def block(ids: list, sizes: list, parts: list) -> pa.RecordBatch:
        h, at, tf = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 3
        order = np.lexsort((at, h))
        h, at, tf = h[order], at[order], tf[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        n = np.concatenate(sizes)
        return _lists(_RAW, [pa.concat_arrays(ids), n, int((n > 0).sum()), int(n.sum()), h[first], np.diff(np.append(first, len(h))), at, tf])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, parts, docs_in, postings = [], [], [], 0, 0
        for batch in batches:
            for begin, end, words in _each(batch.column("text")):
                n = np.diff(words.first)
                low = (words.hashes & mask).astype(np.int64)
                kept = np.flatnonzero(bitmap.value[low >> 3] >> (low & 7).astype(np.uint8) & 1)
                text_of, h = np.repeat(np.arange(end - begin), n)[kept], words.hashes[kept].view(np.int64)
                order = np.lexsort((h, text_of))
                text_of, h = text_of[order], h[order]
                new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (text_of[1:] != text_of[:-1]))) if len(h) else np.zeros(0, np.int64)
                parts.append((h[new], text_of[new] + docs_in, np.diff(np.append(new, len(h)))))
                ids.append(batch.column("id").slice(begin, end - begin))
                sizes.append(n)
                docs_in, postings = docs_in + end - begin, postings + len(new)
                if docs_in >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield block(ids, sizes, parts)
                    ids, sizes, parts, docs_in, postings = [], [], [], 0, 0
        if docs_in:
            yield block(ids, sizes, parts)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return staged(rows.mapInArrow(run, _RAW), "index")


@dataclass
class QuerySet:
    """A bounded set of items as numbers into one sorted table of terms, with the term pairs of each item."""

    terms: np.ndarray  # hashes, sorted
    weights: np.ndarray
    n_docs: int
    n_terms: int
    q: list[int]
    own: list[np.ndarray] = field(default_factory=list)  # terms of each item, lightest first
    pairs: list[list[tuple[int, int, int]]] = field(default_factory=list)  # (pair, a, b) of each item
    single: list[list[int]] = field(default_factory=list)
    table: np.ndarray = None  # terms of each pair

    @classmethod
    def of(cls, items: pd.DataFrame, df: pd.DataFrame, n_docs: int, n_terms: int) -> "QuerySet":
        df = df.sort_values("term")
        ratio = (2 * n_docs + 2) / (2 * df["df"].to_numpy() + 1)
        weights = np.floor(1000 * np.log(ratio)).astype(np.int64)
        out = cls(df["term"].to_numpy(np.int64)[weights > 0], weights[weights > 0], n_docs, n_terms, items["q"].tolist())
        known: dict[tuple[int, int], int] = {}
        for terms in items["terms"]:
            terms = np.asarray(terms, np.int64)
            at = np.searchsorted(out.terms, terms)
            ok = at < len(out.terms)
            at = at[ok][out.terms[at[ok]] == terms[ok]]
            at = at[np.argsort(out.weights[at], kind="stable")]
            out.own.append(at)
            couples = [tuple(sorted((int(a), int(b)))) for a, b in zip(at[0::2], at[1::2])]
            out.pairs.append([(known.setdefault(c, len(known)), *c) for c in couples])
            out.single.append([int(at[-1])] if len(at) % 2 else [])
        out.table = np.array(list(known), np.int64).reshape(-1, 2)
        return out


def _numpy(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def impacts(tf: np.ndarray, n: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Exact impacts; Python's integers take over where a product could leave 64 bits."""
    kind = object if len(n) and (50 * int(n.max()) * n_docs >= 1 << 62 or 10**9 * int(tf.max()) >= 1 << 62) else np.int64
    m = 50 + 50 * n.astype(kind) * n_docs // n_terms
    tf = tf.astype(kind)
    return (weights * (10**9 * tf // (1000 * tf + 20 * m))).astype(np.int64)


def pair_lists(index: DataFrame, queries) -> DataFrame:
    """Blocks with impacts, term maxima and joint maxima of pairs; at the end of a task, its seeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query: QuerySet = queries.value
        seeds = np.zeros((len(query.q), BUCKETS), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                terms, df = _numpy(batch, "terms", row), _numpy(batch, "df", row)
                place = np.searchsorted(query.terms, terms)
                known = place < len(query.terms)
                known[known] = query.terms[place[known]] == terms[known]
                if not known.any():
                    continue
                each = np.repeat(known, df)
                at, tf = _numpy(batch, "at", row)[each], _numpy(batch, "tf", row)[each]
                t, df = place[known], df[known]
                weights = np.repeat(query.weights[t], df)
                impact = impacts(tf, _numpy(batch, "n", row)[at], weights, query.n_docs, query.n_terms)
                starts = np.append(0, np.cumsum(df))
                most = np.maximum.reduceat(impact, starts[:-1])
                ids = batch.column("ids")[row].values
                where = np.full(len(query.terms), -1, np.int64)
                where[t] = np.arange(len(t))
                joint = _joint(query.table, where, starts, at, impact)
                found = np.flatnonzero(joint)
                _seed(query, where, starts, at, impact, len(ids), seeds)
                yield _lists(_SCORED, [ids, t, df, at, impact, most, found, joint[found], None])
        yield _lists(_SCORED, [*[None] * 8, seeds.ravel()])
    return staged(index.mapInArrow(run, _SCORED), "pairs")


def _joint(table: np.ndarray, where: np.ndarray, starts: np.ndarray, at: np.ndarray, impact: np.ndarray) -> np.ndarray:
    """The largest joint impact in the intersection of the lists of each pair; 0 for an empty intersection."""
    out = np.zeros(len(table), np.int64)
    both = where[table] if len(table) else np.zeros((0, 2), np.int64)
    for p in np.flatnonzero((both >= 0).all(axis=1)):
        (a0, a1), (b0, b1) = ((starts[x], starts[x + 1]) for x in both[p])
        if a1 - a0 > b1 - b0:
            a0, a1, b0, b1 = b0, b1, a0, a1
        place = np.minimum(np.searchsorted(at[b0:b1], at[a0:a1]), b1 - b0 - 1) + b0
        hit = at[place] == at[a0:a1]
        if hit.any():
            out[p] = (impact[a0:a1][hit] + impact[place[hit]]).max()
    return out


def _seed(query: QuerySet, where, starts, at, impact, n_docs: int, seeds: np.ndarray) -> None:
    """Partial scores by the heaviest terms: the best of each bucket of documents."""
    width = -(-n_docs // BUCKETS) * BUCKETS
    for i, own in enumerate(query.own):
        acc = np.zeros(width, np.int64)
        for t in where[own[-SEED_TERMS:]]:
            if t >= 0:
                acc[at[starts[t]: starts[t + 1]]] += impact[starts[t]: starts[t + 1]]
        np.maximum(seeds[i], acc.reshape(-1, BUCKETS).max(axis=0), out=seeds[i])


def thresholds(scored: DataFrame, top: int) -> dict[int, int]:
    """For each item of the set a score that ``top`` documents reach: one row an item."""
    rows = (scored.filter("seeds IS NOT NULL").select(F.posexplode("seeds").alias("i", "v"))
            .groupBy("i").agg(F.max("v").alias("v"))
            .groupBy(F.floor(F.col("i") / BUCKETS).cast("int").alias("item"))
            .agg(F.sort_array(F.collect_list("v"), False).alias("v")).select("item", F.get("v", top - 1).alias("v")))
    return {r["item"]: r["v"] or 0 for r in rows.collect()}


class Best:
    """The best documents of an item so far, and the score a further one must reach."""

    def __init__(self, top: int, least: int):
        self.top, self.least = top, least
        self.scores, self.ids, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        self.scores = np.concatenate([self.scores, scores])
        self.ids, self.no_id = np.concatenate([self.ids, ids]), np.concatenate([self.no_id, no_id])
        if len(self.scores) >= self.top:
            kept = np.lexsort((self.ids, self.no_id, -self.scores))[: self.top]
            self.scores, self.ids, self.no_id = self.scores[kept], self.ids[kept], self.no_id[kept]
            self.least = max(self.least, int(self.scores[-1]))


def search_block(pairs, single, t, starts, at, impact, most, joint, n_docs: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of a block that reach ``least`` (at least 1) for an item, their scores, and how many postings were read."""
    units = []
    for p, a, b in pairs:
        a, b = t[a], t[b]
        if a >= 0 and b >= 0:
            units.append((max(joint[p], most[a], most[b]), (a, b)))
        elif a >= 0 or b >= 0:
            x = a if a >= 0 else b
            units.append((most[x], (x,)))
    units += [(most[t[x]], (t[x],)) for x in single if t[x] >= 0]
    if not units:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    units.sort(key=lambda u: u[0])
    bound = np.cumsum([u[0] for u in units])
    split = int(np.searchsorted(bound, least))  # units before it stay below the threshold together
    acc, read = np.zeros(n_docs, np.int64), 0
    for _, lists in units[split:]:
        for x in lists:
            a, b = starts[x], starts[x + 1]
            acc[at[a:b]] += impact[a:b]
            read += b - a
    docs = np.flatnonzero(acc)
    for k in range(split - 1, -1, -1):
        docs = docs[acc[docs] + bound[k] >= least]
        if not len(docs):
            break
        for x in units[k][1]:
            a, b = starts[x], starts[x + 1]
            if len(docs) * 8 < b - a:
                place = np.minimum(np.searchsorted(at[a:b], docs), b - a - 1) + a
                hit = at[place] == docs
                acc[docs[hit]] += impact[place[hit]]
                read += len(docs)
            else:
                acc[at[a:b]] += impact[a:b]
                read += b - a
    docs = docs[acc[docs] >= max(least, 1)]
    return docs, acc[docs], int(read)


def search(scored: DataFrame, queries, least: dict[int, int], top: int = TOP) -> DataFrame:
    """q, doc_id, score: of each task the best ``top`` documents of each item at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query: QuerySet = queries.value
        best = [Best(top, least.get(i, 0)) for i in range(len(query.q))]
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values
                no_id = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null((1 << 63) - 1).to_numpy()
                where = np.full(len(query.terms), -1, np.int64)
                own = _numpy(batch, "t", row)
                where[own] = np.arange(len(own))
                starts = np.append(0, np.cumsum(_numpy(batch, "df", row)))
                at, impact, most = (_numpy(batch, c, row) for c in ("at", "impact", "most"))
                joint = np.zeros(len(query.table), np.int64)
                joint[_numpy(batch, "pair", row)] = _numpy(batch, "joint", row)
                for i, (pairs, single) in enumerate(zip(query.pairs, query.single)):
                    docs, scores, _ = search_block(pairs, single, where, starts, at, impact, most, joint, len(ids), best[i].least)
                    if len(docs):
                        best[i].add(scores, ids[docs], no_id[docs])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(query.q, [len(b.scores) for b in best]), pa.int64()),
             pa.array(np.concatenate([np.zeros(0, np.int64), *[b.ids for b in best]]), pa.int64(),
                      mask=np.concatenate([np.zeros(0, bool), *[b.no_id for b in best]])),
             pa.array(np.concatenate([np.zeros(0, np.int64), *[b.scores for b in best]]), pa.int64())], ["q", "doc_id", "score"])

    return scored.filter("seeds IS NULL").mapInArrow(run, "q bigint, doc_id bigint, score bigint")


def rank(docs: DataFrame, benchmark: DataFrame, top: int = TOP, **columns) -> DataFrame:
    """item_id, rank, doc_id and score of each item's best documents with a score above 0."""
    items = query_terms(benchmark)
    index = build_index(docs, items, **columns)
    facts = index.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    n_docs, n_terms = facts["n_docs"] or 0, facts["n_terms"] or 0
    kind = items.schema["item_id"].dataType.simpleString()
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    if not total or not n_terms:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    df = staged(index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy(F.col("x.terms").alias("term"))
                .agg(F.sum("x.df").alias("df")), "df")
    sets, found = -(-total // QUERY_TERMS), None
    for k in range(sets):
        chosen = items.filter(F.pmod(F.xxhash64("q"), F.lit(sets)) == k)
        terms = df.join(chosen.select(F.explode("terms").alias("term")).distinct(), "term").toPandas()
        query = QuerySet.of(chosen.select("q", "terms").toPandas(), terms, n_docs, n_terms)
        queries = docs.sparkSession.sparkContext.broadcast(query)
        scored = pair_lists(index, queries)
        part = search(scored, queries, thresholds(scored, top), top)
        found = part if found is None else found.unionByName(part)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    share = F.pmod(F.xxhash64("doc_id", "score"), F.lit(64))  # an item's rows from many tasks meet in steps
    first = found.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("q", "share").orderBy(*order)))
    best = (first.filter(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= top))
    return best.join(items.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
