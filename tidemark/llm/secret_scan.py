r"""Secret scan through a trigram inverted index, in DataFrame functions alone.

1. A Boolean query of trigrams is derived from each rule's regular expression (``trigram_query``): any text that matches
   holds all trigrams of one of its conjunctions. Letters are folded to lower case.
2. The index holds, for every trigram that some rule asks for, the texts that have it: postings (trigram, text), a text
   being its 64-bit hash, so copies share their postings and combine before the shuffle.
3. Postings of a conjunction are intersected: the texts that are in all its lists are the rule's candidates.
4. Candidates become a bitmap of fixed size for each rule, OR-ed by the executors. The pass that verifies reads every text
   where it lies and applies a rule to the texts its bitmap names; a text that is named by chance has no match. Rules
   without mandatory trigrams (such as runs of hex digits) scan every text.
5. Only lengths leave the verifying pass: of the matches, their values and the text between them. Running sums over them
   give positions in code points.

No text is shuffled. The bitmap has 2^24 bits for each rule; beyond some ten million candidate texts it names more and more
other texts, which costs time but changes nothing.

Base rules are those of ``RULES[:N_BASE]``; the others add spans of further kinds. A match whose value is shorter than the
rule's least length is dropped. Spans of different kinds may overlap.

Defined results: a null or empty text has no spans. Rows are judged one by one, with or without an id, repeated or not. Very
long texts are scanned whole; the spans of one text are put together in one task. An empty table gives no rows. Other
columns, whatever their names, are ignored. Spans that begin together are in the order of the rules.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as kinds, _parser as parser

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.tables import staged

BITMAP_BITS = 24
#: Strings that a part of an expression is spelled out to, and conjunctions of a query, at most; beyond, it asks for less.
MOST_STRINGS, MOST_CONJUNCTIONS = 64, 64
ANYTHING = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``value`` (0: the match) has ``least`` characters or more."""

    name: str
    pattern: str
    value: int = 0
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base kinds with their patterns and least lengths. A run of 24 or more hex digits is the same whether
# runs are matched whole and the shorter ones dropped, or only longer ones matched.
_NAMES = "|".join(map(either_case, ["password", "passwd", "secret", "token", "api_?key"]))
RULES = [
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
]
N_BASE = 3


def _simplest(query: Iterable[frozenset]) -> frozenset:
    """Without conjunctions that another one implies."""
    query = set(query)
    return frozenset(c for c in query if not any(other < c for other in query))


def _both(a: frozenset, b: frozenset) -> frozenset:
    if len(a) * len(b) > MOST_CONJUNCTIONS:
        return a if ANYTHING != a and (b == ANYTHING or len(a) <= len(b)) else b
    return _simplest(x | y for x in a for y in b)


def _of_strings(strings: set[str]) -> frozenset:
    return _simplest(frozenset(s[i: i + 3] for i in range(len(s) - 2)) for s in strings)


def _products(a: set[str], b: set[str]) -> set[str] | None:
    return {x + y for x in a for y in b} if len(a) * len(b) <= MOST_STRINGS else None


def _spelled(op, value) -> set[str] | None:
    """All strings a node matches, in lower case, if they are few."""
    if op == kinds.LITERAL:
        return {chr(value).lower()}
    if op == kinds.AT:
        return {""}
    if op == kinds.IN:
        chars: set[str] = set()
        for kind, x in value:
            if kind == kinds.LITERAL:
                chars.add(chr(x).lower())
            elif kind == kinds.RANGE and x[1] - x[0] < MOST_STRINGS:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if op == kinds.SUBPATTERN:
        return _all_spelled(value[-1])
    if op == kinds.BRANCH:
        parts = [_all_spelled(p) for p in value[1]]
        return set().union(*parts) if None not in parts and sum(map(len, parts)) <= MOST_STRINGS else None
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        low, high, inner = value
        own = _all_spelled(inner)
        if own is None or high == kinds.MAXREPEAT or high > 8:
            return None
        runs, out = {""}, set()
        for k in range(int(high) + 1):
            out |= runs if k >= low else set()
            runs = _products(runs, own) or {""}
            if len(out) > MOST_STRINGS or (runs == {""} and own != {""}):
                return None
        return out
    return None


def _all_spelled(nodes) -> set[str] | None:
    out: set[str] | None = {""}
    for op, value in nodes:
        own = _spelled(op, value)
        out = None if own is None or out is None else _products(out, own)
    return out


def _asked(op, value) -> frozenset:
    """The query of a node that is not spelled out."""
    if op == kinds.SUBPATTERN:
        return _of_nodes(value[-1])
    if op == kinds.BRANCH:
        every = _simplest(c for part in value[1] for c in _of_nodes(part))
        return every if len(every) <= MOST_CONJUNCTIONS else ANYTHING
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[0] >= 1:
        return _of_nodes(value[2])
    return ANYTHING


def _of_nodes(nodes) -> frozenset:
    query, run = ANYTHING, {""}
    for op, value in nodes:
        own = _spelled(op, value)
        longer = _products(run, own) if own is not None else None
        if longer is not None:
            run = longer
            continue
        query = _both(query, _of_strings(run))
        run = {""} if own is None else own
        if own is None:
            query = _both(query, _asked(op, value))
    return _both(query, _of_strings(run))


def trigram_query(pattern: str) -> list[list[str]]:
    """Conjunctions of trigrams, one of which every matching text holds whole; none if the pattern has no such query."""
    query = _of_nodes(parser.parse(pattern))
    return [] if frozenset() in query else sorted(sorted(c) for c in query)


def postings(docs: DataFrame, trigrams: list[str], text_col: str = "text") -> DataFrame:
    """The index: (trigram, text) for the given trigrams of lower-cased texts, a text being its hash."""
    asked = F.array(*map(F.lit, trigrams))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # one lambda holds the lower-cased text, so that it is made once for all trigrams
    held = F.get(F.transform(F.array(F.lower(text)), lambda low: F.filter(asked, lambda t: F.contains(low, t))), F.lit(0))
    rows = docs.select(F.xxhash64(text).alias("text"), held.alias("held")).filter(F.size("held") > 0)
    return staged(rows.select("text", F.explode("held").alias("trigram")).distinct(), "postings")


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, text): texts that are in every list of one of the rule's conjunctions."""
    terms = [(r, c, t, len(trigrams)) for r, rule in enumerate(rules)
             for c, trigrams in enumerate(trigram_query(rule.pattern)) for t in trigrams]
    asked = index.sparkSession.createDataFrame(terms, "rule int, conjunction int, trigram string, need long")
    return (index.join(F.broadcast(asked), "trigram").groupBy("rule", "conjunction", "need", "text")  # as many rows as rules ask for
            .agg(F.count("*").alias("held")).filter("held = need").select("rule", "text").distinct())


def _low(text_hash: Column) -> Column:
    return text_hash.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))


def bitmaps(found: DataFrame, n_rules: int) -> DataFrame:
    """One row for each 64 bits: word, and the bits of each rule. At most 2^(BITMAP_BITS - 6) rows."""
    bit = F.expr(f"shiftleft(1L, cast((text & {(1 << BITMAP_BITS) - 1}L) & 63 AS int))")
    return (found.select("rule", F.shiftright(_low(F.col("text")), 6).alias("word"), bit.alias("bit")).groupBy("word")
            .agg(*[F.coalesce(F.bit_or(F.when(F.col("rule") == r, F.col("bit"))), F.lit(0).cast("bigint")).alias(f"bits_{r}")
                   for r in range(n_rules)]))


def _lengths(strings: Column) -> Column:
    return F.transform(strings, F.length)


def verify(docs: DataFrame, named: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: row, doc_id and, for each rule with matches, lengths of gaps, matches and values in turn."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hashed = F.xxhash64("text")
    rows = rows.withColumn("word", F.shiftright(_low(hashed), 6)).withColumn("bit", hashed.bitwiseAND(F.lit(63)).cast("int"))
    rows = rows.join(F.broadcast(named), "word", "left")
    found = []
    for r, rule in enumerate(rules):
        matches = F.col("text").rlike(rule.pattern)
        if trigram_query(rule.pattern):
            matches = (F.getbit(F.coalesce(F.col(f"bits_{r}"), F.lit(0).cast("bigint")), F.col("bit")) == 1) & matches
        lengths = F.struct(
            F.lit(r).alias("rule"), _lengths(F.split("text", rule.pattern, -1)).alias("gaps"),
            _lengths(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))).alias("lens"),
            _lengths(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.value))).alias("vals"))
        found.append(F.when(matches, lengths))
    out = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.array_compact(F.array(*found)).alias("found"))
    return staged(out, "matches")


def spans_of(verified: DataFrame, rules: list[Rule]) -> DataFrame:
    """(row, rule, begin, end) of the matches that are long enough, in code points, end exclusive."""
    each = verified.select("row", F.explode("found").alias("f")).select(
        "row", "f.rule", F.posexplode(F.arrays_zip("f.gaps", "f.lens", "f.vals")).alias("k", "m"))
    in_turn = Window.partitionBy("row", "rule").orderBy("k")
    end = F.sum(F.col("m.gaps") + F.col("m.lens")).over(in_turn)
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("rule") + 1)
    return (each.filter("m.lens IS NOT NULL").withColumn("end", end)
            .filter(F.col("m.vals") >= least).select("row", "rule", (F.col("end") - F.col("m.lens")).alias("begin"), "end"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Per row: doc_id and spans, an array of (begin, rule, end) in order."""
    rules = RULES if rules is None else rules
    trigrams = sorted({t for rule in rules for c in trigram_query(rule.pattern) for t in c})
    found = candidates(postings(docs, trigrams, text_col), rules)
    verified = verify(docs, bitmaps(found, len(rules)), rules, id_col, text_col)
    lists = spans_of(verified, rules).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("begin", "rule", "end"))).alias("spans"))
    empty = F.array().cast("array<struct<begin:bigint,rule:int,end:bigint>>")
    return verified.select("row", "doc_id").join(lists, "row", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def as_text(spans: Column, rules: list[Rule]) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(r.name) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rule"] + 1), s["begin"], s["end"])), ",")
