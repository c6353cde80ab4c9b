"""Queries of the subpackage and the SQL they must equal, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, html_text, lexical, ngram_join, packing, quality_model, quality_rules, secret_scan, substrings, token_counts, token_store, toxicity, whitening
from tidemark.llm.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run
    return add


@query("op7_substring_dedup", r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
owned AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS owner FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM owned WHERE owner < doc_id),
placed AS (SELECT doc_id, len(w) AS n_words, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
  FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)""")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.find_repeats(load(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed",
        F.when(F.col("n_removed") > 0, F.sha2("kept", 256)).otherwise(F.lower(F.hex("sha"))).alias("kept_sha256"))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts.count_tokens(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op8_token_output")
def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_tokens(
        load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), vocabulary=49_408, end_id=1)
    return token_store.read_digests(manifest)


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(load(spark, sf_dir, "pages"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op6_ngram_join", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)])) END AS s FROM words),
kinds AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT rep, n, unnest(s) AS token FROM kinds),
links AS (
  SELECT a.rep AS x, b.rep AS y FROM tokens a JOIN tokens b ON a.token = b.token AND a.rep <> b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (
  SELECT rep AS x, rep AS y FROM kinds
  UNION
  SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x),
classes AS (SELECT x AS rep, min(y) AS component_id FROM reached GROUP BY x)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN kinds ON sets.s = kinds.s AND len(sets.s) > 0 LEFT JOIN classes USING (rep)""")
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(load(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


_MEASURED = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS three
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM twice) GROUP BY doc_id),
measured AS (
  SELECT words.doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [n_symbols / greatest(n_words, 1), n_dup_lines / greatest(n_lines, 1), n_repeat_words / greatest(n_words, 1),
     word_chars / greatest(n_words, 1)] AS v FROM measured)"""


@query("op9_quality_rules", _MEASURED + r""",
holdout AS (SELECT * FROM based SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id) WHERE NOT base_failed),
grid AS (
""" + " UNION ALL ".join(
    f"SELECT {r} AS rule, unnest({list(cutoffs)})::DOUBLE AS cutoff" for r, cutoffs in enumerate(quality_rules.GRIDS.values(), 1)) + r"""),
counted AS (
  SELECT stratum, rule, cutoff, count(*) AS n, count(*) FILTER (v[rule] > cutoff) AS k FROM holdout, grid GROUP BY ALL),
tested AS (
  SELECT *, list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.005) + (n - i) * ln(0.995))
                      FOR i IN range(0, k + 1)]) AS tail FROM counted WHERE k < n * 0.005),
cutoffs AS (
  SELECT stratum, rule, min(cutoff) AS cutoff FROM tested
  WHERE tail <= 0.05 / ((SELECT count(DISTINCT stratum) FROM holdout) * 40) GROUP BY stratum, rule),
rejected AS (SELECT DISTINCT doc_id FROM based JOIN cutoffs USING (stratum) WHERE v[rule] > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM based""")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op5_decontamination", r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
words AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM texts),
sizes AS (SELECT DISTINCT least(5, len(w)) AS k FROM words WHERE kind = 'i' AND len(w) > 0),
shingles AS (
  SELECT DISTINCT kind, id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT kind, id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, sizes
        WHERE len(w) >= k AND (kind = 'd' OR k = least(5, len(w))))),
items AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'i' GROUP BY id),
found AS (
  SELECT d.id AS doc_id, i.id AS item, count(*) AS held FROM shingles d JOIN shingles i ON d.s = i.s AND d.k = i.k
  WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY d.id, i.id),
kept AS (SELECT doc_id, count(*) AS n_items, min(item) AS first_item FROM found JOIN items ON item = items.id
         WHERE 100 * held >= 80 * n GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(first_item, -1) AS first_item
FROM documents LEFT JOIN kept USING (doc_id)""")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return marked.select(F.col("id").alias("doc_id"), "contaminated", "n_items", F.coalesce("first_item", F.lit(-1)).alias("first_item"))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query("op12_lexical_search", rf"""
WITH docs AS (SELECT doc_id, {_TERMS} AS w FROM documents),
facts AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs),
held AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), facts),
items AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM items JOIN held USING (term) JOIN weights USING (term), facts GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50""")
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def _found(k: int, rule: secret_scan.Rule) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return (f"SELECT r, {k} AS kind, '{rule.name}' AS name, {rule.least} AS least, string_split_regex(text, {pattern}) AS gaps, "
            f"regexp_extract_all(text, {pattern}) AS m, regexp_extract_all(text, {pattern}, {rule.value}) AS v FROM texts")


@query("op13_secret_scan", """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS (
""" + " UNION ALL ".join(_found(k, rule) for k, rule in enumerate(secret_scan.RULES)) + f"""),
each AS (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM found WHERE len(m) > 0),
spans AS (
  SELECT r, kind, name, length(m[k]) AS n,
         list_sum([length(x) FOR x IN gaps[1:k]]) + coalesce(list_sum([length(x) FOR x IN m[1:k - 1]]), 0) AS b
  FROM each WHERE length(v[k]) >= least),
named AS (SELECT r, kind, b, concat_ws(':', name, b, b + n) AS span FROM spans)
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY b, kind) FILTER (kind < {secret_scan.N_BASE}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY b, kind), '') AS spans
FROM texts LEFT JOIN named USING (r) GROUP BY r, doc_id""")
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules, found = secret_scan.RULES, secret_scan.scan(load(spark, sf_dir, "documents"))
    kinds = F.transform("spans", lambda s: s["rule"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{rule.name}")
              for k, rule in enumerate(rules[:secret_scan.N_BASE])]
    base = F.filter("spans", lambda s: s["rule"] < secret_scan.N_BASE)
    return found.select("doc_id", *counts, F.sha2(secret_scan.as_text(base, rules), 256).alias("base_sha256"),
                        secret_scan.as_text(F.col("spans"), rules).alias("spans"))
