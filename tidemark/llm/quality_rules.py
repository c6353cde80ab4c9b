"""Quality rules with risk-controlled thresholds, in DataFrame functions alone.

A rule compares a measure of the text with a cutoff and rejects what exceeds it. Cutoffs are chosen for each stratum (the
language) from a holdout of rows labelled good: of a grid of cutoffs the strictest is taken for which an exact binomial
test shows that at most ``risk`` of the good documents of the stratum exceed it. The test level is divided by the number
of strata, rules and grid cutoffs tested (Bonferroni), so with probability ``1 - delta`` no cutoff breaks its limit.
The limit of a rule is the risk divided by the number of rules, which bounds the false rejections of all together. A
stratum with too few labelled rows for any cutoff has none and keeps everything the base rules keep.

Measures of a text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (see ``measures``). Rules divide them by
the number of words or of lines.

Defined results: a null text has no words and fails the base rules (fewer than 50 words). Null languages form a stratum
of their own. Labels of one id count once, good if any is; rows sharing an id are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.tables import staged

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
RISK, DELTA = 0.02, 0.05
#: Grid of cutoffs of each rule, strictest first (fixed, so that it cannot follow the labels).
GRIDS = {
    "symbols_per_word": [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0],
    "dup_line_share": [0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9],
    "repeat_word_share": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5],
    "chars_per_word": [6.0, 6.5, 7.0, 7.5, 8.0, 8.5, 9.0, 10.0, 12.0, 15.0],
}


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars (code points in words), n_symbols (characters of ``SYMBOLS``), n_dup_lines (lines
    with a word, equal to an earlier line), n_lines (lines with a word) and n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, " \t\x0b\x0c\r", "")) > 0)
    with_words = (docs.withColumn("_words", words).withColumn("_lines", lines)
                  .withColumn("n_words", F.size("_words").cast("bigint")))
    spaces = " \t\n\x0b\x0c\r"
    hashes = F.when(F.col("n_words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))))
    hashed = (with_words
              .withColumn("word_chars", F.length(F.translate(text, spaces, "")).cast("bigint"))
              .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"))
              .withColumn("n_lines", F.size("_lines").cast("bigint"))
              .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"))
              .withColumn("_hashes", hashes).drop("_words", "_lines"))
    # only texts with some repeated window sort their windows with their places
    placed = F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.sort_array(F.transform(
        "_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    sorted_rows = hashed.withColumn("_placed", placed).drop("_hashes")
    repeated = F.filter("_placed", lambda x, k: (F.get("_placed", k - 1)["h"] == x["h"]) | (F.get("_placed", k + 1)["h"] == x["h"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    return sorted_rows.withColumn("n_repeat_words", F.when(F.col("_placed").isNull(), 0).otherwise(covered).cast("bigint")).drop("_placed")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_value(rule: str) -> Column:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbols_per_word": F.col("n_symbols") / words,
            "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "repeat_word_share": F.col("n_repeat_words") / words,
            "chars_per_word": F.col("word_chars") / words}[rule]


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exactly, by its terms' recurrence scaled by the largest so far."""
    odds = p / (1 - p)
    start = F.struct((n * F.log1p(F.lit(-p))).alias("log_term"), (n * F.log1p(F.lit(-p))).alias("log_sum"))

    def add(state: Column, i: Column) -> Column:
        term = state["log_term"] + F.log((n - i + 1) / i * F.lit(odds))
        high, low = F.greatest(term, state["log_sum"]), F.least(term, state["log_sum"])
        return F.struct(term.alias("log_term"), (high + F.log1p(F.exp(low - high))).alias("log_sum"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.exp(F.aggregate(steps, start, add)["log_sum"])


def select_cutoffs(holdout: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, rule, cutoff: the strictest cutoff that is shown safe, from good rows with measures and a stratum."""
    limit = risk / len(GRIDS)
    grid = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(c).cast("double").alias("cutoff"), (rule_value(rule) > c).alias("over"))
                     for rule, cutoffs in GRIDS.items() for c in cutoffs])
    counted = (holdout.select("stratum", F.explode(grid).alias("g"))
               .groupBy("stratum", "g.rule", "g.cutoff").agg(F.count("*").alias("n"), F.count_if("g.over").alias("k")))
    strata = holdout.select("stratum").distinct().agg(F.count("*").alias("strata"))
    level = F.lit(delta) / (F.col("strata") * sum(map(len, GRIDS.values())))
    # a tail is only worked out below its mean, elsewhere it is far over any level
    safe = F.when(F.col("k") < F.col("n") * limit, binomial_tail(F.col("k"), F.col("n"), limit)).otherwise(1.0) <= level
    return (counted.join(F.broadcast(strata)).filter(safe)  # one row
            .groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff")))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Per row of ``docs``: doc_id, stratum, the measures, base_failed, rejected_by (rules over their cutoff) and kept."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                       F.col(text_col).alias("text"))
    measured = staged(measures(rows).drop("text").withColumn("base_failed", base_failed()), "measures")
    good = (labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("good_id")).distinct())
    # documents that the base rules reject anyway are no false rejections of a cutoff
    holdout = measured.filter("NOT base_failed").join(good, F.col("doc_id") == F.col("good_id"), "left_semi")
    cutoffs = select_cutoffs(holdout, risk, delta)
    wide = cutoffs.groupBy("stratum").pivot("rule", list(GRIDS)).agg(F.first("cutoff"))
    wide = wide.select("stratum", *[F.col(r).alias(f"cut_{r}") for r in GRIDS])
    over = [F.when(rule_value(r) > F.col(f"cut_{r}"), F.lit(r)) for r in GRIDS]
    return (measured.join(wide, "stratum", "left").withColumn("rejected_by", F.array_compact(F.array(*over)))
            .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)))
