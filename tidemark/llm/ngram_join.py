"""N-gram Jaccard join by signature trees, reported as classes of linked documents.

1. Every whole text becomes its set of distinct word shingles. Documents with one and the same set are one class from the
   start; from here on only its smallest id, the representative, takes part.
2. Two linked sets share one of their first ``n - ceil(t * n) + 1`` tokens in any fixed order (prefix filter) and lie in
   one band of sizes, so they meet in a group (token, band). The order is by hash, but common tokens come last: a first
   pass counts all low hashes in a table of fixed size, and what is far above its mean is common. The counts only shape
   the order, so the search stays exact whatever they are. Groups with the same members are looked at once. Groups of
   more than ``GROUP`` members are cut into chunks whose pairs are dealt to tasks.
3. In each group a signature tree is built over OR-combined token bitmaps and size ranges and traversed against itself;
   node pairs are pruned by the largest overlap they could have. What cannot be pruned is joined, as a forest, into
   clusters of possibly similar documents; no pair is written for documents that are already together.
4. The documents of a cluster meet with their texts. A tree over them is traversed again, now with exact intersections,
   and yields links that connect what is linked. Clusters beyond a size are cut into chunks that each hold the same few
   hubs; then all documents outside the cluster's largest class meet every chunk. Pairs inside one class need no look.

Nothing is capped: every pair over the threshold ends in one class. Set equality rests on 128-bit hashes, tokens on 64.

Defined results: a null text, or one without words, is empty and linked with nothing. Rows without an id belong to no
class (null). Rows that share an id are linked to whatever any of them is linked to. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.signature_tree import Forest, SignatureTree, bits_of, dual_traversal, fold, least_overlap, order_for_tree
from tidemark.llm.tables import released, staged
from tidemark.llm.wordhash import each_words, mix, shingles_of

#: Counters for common tokens (a power of two), the share of hashes they count, and how far above the mean is common.
COUNTERS, COUNTED_SHARE, COMMON_COUNT, COMMON_FACTOR = 1 << 22, 0.2, 24, 16
ID_BITS = 24
GROUP, CLUSTER, CLUSTER_TOKENS, HUBS = 2_048, 1_024, 1_000_000, 16
_FACTS = "id string, n bigint, digest binary, keys array<bigint>, bits binary"


def band_of(n: int) -> int:
    return n.bit_length() - 1


def width_of(n: int) -> int:
    """Bits of a bitmap: two to four for each token."""
    return max(64, 1 << (band_of(n) + 2))


def _counter(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens) & np.uint64(COUNTERS - 1)).astype(np.int64)


def _count_tokens(k: int, lower: bool):
    """Counts of low-hash tokens by counter; a counter below 3 in a task is left out."""
    limit = np.uint64(int(COUNTED_SHARE * 2.0**64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            for _, _, words in each_words(batch["text"], lower):
                tokens, _ = shingles_of(words, k)
                np.add.at(counts, _counter(tokens[tokens < limit]), 1)
        at = np.flatnonzero(counts >= 3)
        yield pd.DataFrame({"at": at.astype(np.int32), "n": counts[at].astype(np.int64)})
    return run


def common_tokens(texts: DataFrame, k: int, lower: bool) -> np.ndarray:
    """For each counter whether its tokens are common; at most ``COUNTERS`` numbers reach the driver."""
    counted = staged(texts.mapInPandas(released(_count_tokens(k, lower)), "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")), "counts")
    total = counted.agg(F.sum("n")).first()[0] or 0
    common = np.zeros(COUNTERS, bool)
    rows = counted.filter(F.col("n") >= max(COMMON_COUNT, COMMON_FACTOR * total // COUNTERS)).select("at").toPandas()
    common[rows["at"].to_numpy(np.int64)] = True
    return np.packbits(common)


def group_keys(tokens: np.ndarray, percent: int, common: np.ndarray | None = None) -> np.ndarray:
    """Keys under which a sorted set meets every set it can be linked with; tokens of ``common`` counters come last."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64)
    size = n - -(-percent * n // 100) + 1
    prefix = tokens[:size]
    if common is not None:
        at = _counter(tokens[: min(n, 2 * size)])
        often = (common[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        if (~often).sum() < size:  # look at all tokens
            at = _counter(tokens)
            often = (common[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        prefix = np.concatenate([tokens[: len(often)][~often][:size], tokens[: len(often)][often]])[:size]
    bands = [band_of(n)]
    if n * 100 >= percent * (1 << (bands[0] + 1)):  # a partner may reach into the next band
        bands.append(bands[0] + 1)
    return np.concatenate([mix(prefix + np.uint64(b)) for b in bands]).view(np.int64)


def _facts(k: int, percent: int, lower: bool, common):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin, end, words in each_words(batch["text"], lower):
                tokens, where = shingles_of(words, k)
                rows = []
                for a, b in zip(where[:-1], where[1:]):
                    own = np.unique(tokens[a:b])
                    rows.append((len(own), xxhash.xxh3_128_digest(own.tobytes()), group_keys(own, percent, common.value),
                                 bits_of(own, width_of(len(own))).tobytes() if len(own) else b""))
                yield pd.DataFrame(rows, columns=["n", "digest", "keys", "bits"]).assign(
                    id=batch["id"].iloc[begin:end].to_numpy())
    return run


def _as_matrix(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps folded to the narrowest width."""
    arrays = [np.frombuffer(b, np.uint8) for b in bitmaps]
    width = min(len(a) for a in arrays) * 8
    return np.stack([fold(a, width) for a in arrays])


def star(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links with the same components, each id with the smallest of its component: no long chains are left to follow."""
    root: dict[int, int] = {}

    def find(a: int) -> int:
        while root.setdefault(a, a) != a:
            root[a] = a = root[root[a]]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [(a, r) for a in list(root) if (r := find(a)) != a]


def _cluster_groups(percent: int):
    """Forest edges of possibly similar members of each group; rows come sorted by group."""
    keys = ["kb", "ci", "cj"]

    def edges_of(ids: np.ndarray, sizes: np.ndarray, bits: list[bytes]) -> list[tuple[int, int]]:
        matrix = _as_matrix(bits)
        order = order_for_tree(sizes, matrix[:, 0])
        ids, edges = ids[order], []
        tree = SignatureTree(matrix[order], sizes[order])

        def note(i: int, j: int) -> bool:
            edges.append((ids[i], ids[j]))
            return True

        dual_traversal(tree, tree, percent, Forest(len(ids)), note)
        return star(edges)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            edges, rest = groups(rows, False)
            yield edges
        if rest is not None and len(rest):
            yield groups(rest, True)[0]

    def groups(rows: pd.DataFrame, last: bool) -> tuple[pd.DataFrame, pd.DataFrame]:
        key = rows[keys].to_numpy()
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))) if len(rows) else np.zeros(0, int)
        ends = np.append(starts[1:], len(rows))
        if not last and len(starts):
            starts, ends = starts[:-1], ends[:-1]
        ids, sizes, bits, out = rows["id"].to_numpy(), rows["n"].to_numpy(), rows["bits"].tolist(), []
        for a, b in zip(starts, ends):
            if b - a > 1:
                out += edges_of(ids[a:b], sizes[a:b], bits[a:b])
        done = ends[-1] if len(ends) else 0
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64), rows.iloc[done:]
    return run


def _keep_pairs(percent: int):
    """Pairs whose bitmaps and sizes allow a link."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for row in batch.itertuples(index=False):
                bits = _as_matrix([row.bits_a, row.bits_b])
                spare = np.array([row.n_a, row.n_b]) - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
                shared = int(np.bitwise_count(bits[0] & bits[1]).sum()) + int(spare.min())
                keep.append(shared >= least_overlap(row.n_a, row.n_b, percent)
                            and 100 * min(row.n_a, row.n_b) >= percent * max(row.n_a, row.n_b))
            yield batch.loc[keep, ["a", "b"]]
    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the Jaccard similarity."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    overlap = int((both[1:] == both[:-1]).sum())
    return 100 * overlap >= percent * (len(a) + len(b) - overlap)


def _link_cluster(k: int, percent: int, lower: bool):
    """Links that connect what is linked among the documents of a group; ``outer`` ones are compared with all, the
    others (if any outer ones are there) only with them."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group, sets, with_outer = group.drop_duplicates(["id", "text"]), [], group["outer"].any()
        for _, _, words in each_words(group["text"], lower):
            tokens, where = shingles_of(words, k)
            sets += [np.unique(tokens[a:b]) for a, b in zip(where[:-1], where[1:])]
        group = group[[len(s) > 0 for s in sets]]  # other rows of an id may have no words; they link with nothing
        sets = [s for s in sets if len(s)]
        if not sets or with_outer and not group["outer"].any():
            return pd.DataFrame([], columns=["a", "b"], dtype=np.int64)
        ids = group["id"].to_numpy()
        sizes = np.array([len(s) for s in sets])
        outer = group["outer"].to_numpy(bool)
        bits = _as_matrix([bits_of(s, width_of(len(s))).tobytes() for s in sets])
        edges: list[tuple[int, int]] = []

        def tree_of(chosen: np.ndarray) -> tuple[np.ndarray, SignatureTree]:
            at = chosen[order_for_tree(sizes[chosen], np.array([sets[i][0] for i in chosen], np.uint64))]
            return at, SignatureTree(bits[at], sizes[at])

        def join(left: np.ndarray, right: np.ndarray | None) -> None:
            at, tree = tree_of(left)
            to, other = (at, tree) if right is None else tree_of(right)
            forest = Forest(len(at) + (0 if right is None else len(to)))
            offset = 0 if right is None else len(at)
            if right is not None and "component" in group:  # what earlier rounds joined
                known: dict[int, int] = {}
                for place, i in enumerate([*at.tolist(), *to.tolist()]):
                    forest.join(place, known.setdefault(group["component"].iloc[i], place))

            def verify(i: int, j: int) -> bool:
                if linked(sets[at[i]], sets[to[j]], percent):
                    edges.append((ids[at[i]], ids[to[j]]))
                    return True
                return False

            dual_traversal(tree, other, percent, forest, verify, offset)

        if outer.any():
            join(np.flatnonzero(outer), None)
            if not outer.all():
                join(np.flatnonzero(outer), np.flatnonzero(~outer))
        else:
            join(np.arange(len(ids)), None)
        return pd.DataFrame(star(edges), columns=["a", "b"], dtype=np.int64)
    return run


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85,
                    lower: bool = True) -> DataFrame:
    """Per row of ``docs``: id, n_shingles and component_id, the smallest id reachable by links of Jaccard similarity
    ``percent`` or more between sets of ``k``-word shingles."""
    named = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    common = docs.sparkSession.sparkContext.broadcast(common_tokens(named.select("text"), k, lower))
    facts = staged(named.mapInPandas(released(_facts(k, percent, lower, common)), _FACTS)  # ids as text: pandas has no integers with nulls
                   .withColumn("id", F.col("id").cast("bigint")).withColumn("row", F.monotonically_increasing_id()), "shingles")
    # one representative for each set, and one of its rows; ids with several texts tie their sets together
    first = facts.filter("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"), F.min("row").alias("first_row"))
    first = staged(first, "first")  # both sides of a join on a hot key are plain shuffles, which AQE can split
    placed = facts.select("id", "n", "digest").join(first.select("digest", "rep"), "digest", "left")
    sets = staged(facts.join(first, "digest").filter("row = first_row").select(F.col("rep").alias("id"), "n", "keys", "bits"), "sets")
    twins = placed.filter("rep < id").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    # groups of one go first: most keys have one member, and no more than their counts is shuffled to find that out. The
    # hint keeps the plan the same at every size
    keyed = sets.select("id", F.explode("keys").alias("kb"))
    several = staged(keyed.groupBy("kb").agg(F.count("*").alias("c")).filter("c > 1"), "several")
    keyed = staged(keyed.join(several.select("kb").hint("merge"), "kb"), "keyed")
    groups = (keyed.groupBy("kb").agg(
        F.count("*").alias("c"), F.min("id").alias("a"), F.max("id").alias("b"),
        F.bit_xor(F.xxhash64("id")).alias("s1"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("s2"))
        .groupBy("s1", "s2", "c")
        .agg(F.min("kb").alias("kb"), F.first("a").alias("a"), F.first("b").alias("b")))
    groups = staged(groups, "groups")
    marks = sets.select("id", "n", "bits")
    pairs = (groups.filter("c = 2 AND a < b").select("a", "b")
             .join(marks.selectExpr("id AS a", "n AS n_a", "bits AS bits_a"), "a")
             .join(marks.selectExpr("id AS b", "n AS n_b", "bits AS bits_b"), "b")
             .mapInPandas(released(_keep_pairs(percent)), "a bigint, b bigint"))
    chunks = F.when(F.col("c") > GROUP, F.ceil(F.col("c") * 2 / GROUP)).otherwise(1).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("m")).cast("int")
    members = (keyed.select("kb", "id").join(groups.filter("c > 2").select("kb", chunks.alias("m")), "kb")
               .withColumn("h", own).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
               .select("kb", "id", F.least("h", "j").alias("ci"), F.greatest("h", "j").alias("cj")))
    dealt = (members.join(marks, "id").repartition("kb", "ci", "cj").sortWithinPartitions("kb", "ci", "cj", "n")
             .mapInPandas(released(_cluster_groups(percent)), "a bigint, b bigint"))
    maybe = staged(pairs.unionByName(dealt).distinct(), "candidates")

    clusters = connected_components(maybe).withColumnRenamed("component", "cluster")
    ends = maybe.selectExpr("a AS id").unionByName(maybe.selectExpr("b AS id")).groupBy("id").agg(F.count("*").alias("degree"))
    sized = clusters.join(ends, "id").join(sets.select("id", "n"), "id")
    extent = _extent(sized)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    texts = _likely(texts, clusters).join(clusters, "id")  # most texts stay out of the shuffle
    cast = staged(texts.join(extent, "cluster"), "clusters").withColumn("h", F.pmod(F.xxhash64("id"), F.col("m")).cast("int"))
    schema = "a bigint, b bigint"
    link = _link_cluster(k, percent, lower)
    plain = cast.select("cluster", "h", "id", "text", F.lit(False).alias("outer"))
    hubs = cast.filter("m > 1 AND array_contains(hubs, id)").select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("h"), "id", "text", F.lit(False).alias("outer"))
    links = staged(plain.unionByName(hubs).groupBy("cluster", "h").applyInPandas(link, schema), "links1")

    large = cast.filter("m > 1").select("cluster", "id", "text", "m", "h")
    if not large.isEmpty():
        roots = connected_components(links).withColumnRenamed("component", "root")
        known = large.join(roots, "id", "left").withColumn("component", F.coalesce("root", "id"))
        size = known.groupBy("cluster", "component").agg(F.count("*").alias("c"))
        main = size.groupBy("cluster").agg(F.max_by("component", F.struct("c", F.col("component"))).alias("main"))
        split = known.join(main, "cluster")
        outside = split.filter("component <> main")
        counts = outside.groupBy("cluster").agg(F.ceil(F.count("*") / CLUSTER).cast("int").alias("u"))
        outer = (outside.join(counts, "cluster")
                 .withColumn("g", F.pmod(F.xxhash64("id"), F.col("u")).cast("int"))
                 .withColumn("h", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
                 .select("cluster", "g", "h", "id", "text", "component", F.lit(True).alias("outer")))
        inner = (split.join(counts, "cluster").withColumn("g", F.explode(F.sequence(F.lit(0), F.col("u") - 1)))
                 .select("cluster", "g", "h", "id", "text", "component", F.lit(False).alias("outer")))
        more = outer.unionByName(inner).groupBy("cluster", "g", "h").applyInPandas(_unlike(link), schema)
        links = links.unionByName(staged(more, "links2"))
    final = connected_components(links.unionByName(twins))
    return (placed.join(final, "id", "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


def _likely(texts: DataFrame, clusters: DataFrame) -> DataFrame:
    """``texts`` without most of those that are in no cluster, by a bitmap of fixed size of the ids' hashes; the executors
    OR it together, and at most 2^18 words of it reach the driver."""
    low = F.xxhash64("id").bitwiseAND((1 << ID_BITS) - 1)
    words = (clusters.select(low.alias("low")).groupBy(F.shiftright("low", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(low & 63 AS int))")).alias("bits")).collect())
    table = np.zeros(1 << (ID_BITS - 6), np.int64)
    for row in words:
        table[row["word"]] = row["bits"]
    bitmap = texts.sparkSession.sparkContext.broadcast(table.view(np.uint8))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch["low"].to_numpy(np.int64)
            found = (bitmap.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            yield batch.loc[found, ["id", "text"]]

    return texts.filter("id IS NOT NULL").withColumn("low", low).mapInPandas(keep, "id bigint, text string")


def _extent(sized: DataFrame) -> DataFrame:
    """Chunks of each cluster, and the ids of its hubs: those with the highest degree, a bounded number for each."""
    chunks = F.greatest(F.ceil(F.count("*") / CLUSTER), F.ceil(F.sum("n") / CLUSTER_TOKENS)).cast("int")
    # one hub for each remainder of the id's hash: maxima combine before the shuffle, whatever the cluster's size
    hubs = [F.max_by(F.when(F.pmod(F.xxhash64("id"), F.lit(HUBS)) == r, F.col("id")),
                     F.when(F.pmod(F.xxhash64("id"), F.lit(HUBS)) == r, F.struct("degree", "id"))) for r in range(HUBS)]
    return sized.groupBy("cluster").agg(chunks.alias("m"), F.array_compact(F.array(*hubs)).alias("hubs"))


def _unlike(link):
    """A document that is outer does not meet itself among the others."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        outer = set(group.loc[group["outer"], "id"])
        return link(group[group["outer"] | ~group["id"].isin(outer)])
    return run
