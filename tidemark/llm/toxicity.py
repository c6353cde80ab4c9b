"""Toxicity by weak supervision.

1. Voters are mined from a bounded sample of labelled training rows: whole words (a lexicon) and beginnings of three to
   seven letters that one, two or three different words of a text share (patterns), by their likelihood ratio statistic.
2. One pass over all documents notes which vocabulary terms each text holds.
3. A generative label model of one hidden class per document gives every voter a rate in either class. It starts from
   the mined rates and is fitted by expectation-maximization over all documents, labelled or not. Correlations of voters
   within a class come from the same pass: of voters that repeat each other the best stays, others are discounted.
4. A linear classifier over all vocabulary terms is trained on the posterior labels of the sample, where the given label
   is one more voter of stated accuracy, and scores every text.

Labels are read only from the sample; held-out rows (a given remainder of the checksum of
their id) are never among them. Language, source and id are no inputs.

Defined results: a null or empty text has no terms and gets the score of its intercept. Without labelled rows of both
kinds there are no voters and every score is the share of toxic labels (0 without any). Repeated rows score alike;
several labels of one id count as their largest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import released, staged

#: Labelled rows that voters and classifier are fitted on at most (the smallest hashes of their ids).
MAX_LABELLED = 40_000
MAX_TERMS, MAX_VOTERS, MIN_SUPPORT, MIN_LIFT = 2_048, 192, 5, 4.0
VOTER_SHARE = 0.01  # of the toxic rows that a voter must fire on
#: Correlation within a class from which a voter repeats another, or is discounted; accuracy of the given labels.
REPEATED, CORRELATED, LABEL_ACCURACY = 0.6, 0.3, 0.995
EM_ROUNDS, PREFIXES, REPEATS = 4, (3, 4, 5, 6, 7), (1, 2, 3)
_WORD = re.compile(r"[^\W\d_]+")


def terms_of(text: str | None) -> set[str]:
    """Distinct lower-case words, and beginnings of longer words marked by ``*`` and how many different words have them."""
    words = set(_WORD.findall(text.lower())) if text else set()
    begins = Counter(w[:k] for k in PREFIXES for w in words if len(w) > k)
    return words | {f"{p}*{r}" for p, n in begins.items() for r in REPEATS if n >= r}


def is_held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _mine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen = (Counter(), Counter())
        for text, label in zip(batch["text"], batch["label"]):
            seen[label].update(terms_of(text))
        terms = list(seen[0].keys() | seen[1].keys())
        yield pd.DataFrame({"term": terms, "clean": [seen[0][t] for t in terms], "toxic": [seen[1][t] for t in terms]})


def mine_terms(sample: DataFrame, n_clean: int, n_toxic: int) -> list[tuple[str, int, int]]:
    """The terms that tell the labels apart best, with the number of clean and toxic rows that hold them."""
    counts = sample.mapInPandas(released(_mine), "term string, clean bigint, toxic bigint").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(f"clean + toxic >= {MIN_SUPPORT}")

    def part(seen: str, of: int, expected: F.Column) -> F.Column:
        rest = F.lit(of) - F.col(seen)
        missing = F.lit(of) - F.lit(of) * expected
        own = F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) / (F.lit(of) * expected))).otherwise(0.0)
        return own + F.when((rest > 0) & (missing > 0), rest * F.log(rest / missing)).otherwise(0.0)

    share = (F.col("clean") + F.col("toxic")) / F.lit(n_clean + n_toxic)
    statistic = 2 * (part("clean", n_clean, share) + part("toxic", n_toxic, share))
    best = counts.withColumn("g", statistic).filter("g > 15").orderBy(F.desc("g"), "term").limit(MAX_TERMS)
    kept, seen = [], set()
    for r in best.collect():  # of longer and longer beginnings that the same rows hold, one is enough
        alike = (r["term"][:3], "*" in r["term"], r["clean"], r["toxic"])
        if alike not in seen:
            seen.add(alike)
            kept.append((r["term"], r["clean"], r["toxic"]))
    return kept


def _hold(terms: list[str]):
    words = {t: i for i, t in enumerate(terms) if "*" not in t}
    begins: dict[str, list[tuple[int, int]]] = {}
    for i, term in enumerate(terms):
        if "*" in term:
            begin, _, repeats = term.partition("*")
            begins.setdefault(begin, []).append((int(repeats), i))
    lengths = sorted({len(b) for b in begins})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                own = set(_WORD.findall(text.lower())) if text else ()
                held = [words[w] for w in own if w in words]
                for k in lengths:
                    counts = Counter([b for w in own if (b := w[:k]) in begins and len(w) > k])
                    held += [i for b, n in counts.items() for r, i in begins[b] if n >= r and len(b) == k]
                found.append(np.array(sorted(held), np.int32))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "held": found})
    return run


@dataclass
class LabelModel:
    """Rates of voters in the toxic and the clean class; ``weight`` discounts correlated voters."""

    share: float
    toxic: np.ndarray
    clean: np.ndarray
    weight: np.ndarray
    silent_toxic: float
    silent_clean: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of the toxic class for rows of 0/1 votes; a voter that is silent abstains, all silent is a vote."""
        odds = np.log(self.share / (1 - self.share)) + votes @ (self.weight * np.log(self.toxic / self.clean))
        odds = odds + np.where(votes.any(axis=1), 0.0, np.log(self.silent_toxic / self.silent_clean))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _votes(held: pd.Series, voters: np.ndarray) -> np.ndarray:
    place = np.full(MAX_TERMS + 1, -1)
    place[voters] = np.arange(len(voters))
    rows = np.repeat(np.arange(len(held)), [len(h) for h in held])
    columns = place[np.concatenate([np.asarray(h, np.int64) for h in held])] if len(rows) else rows
    out = np.zeros((len(held), len(voters)), np.float32)
    out[rows[columns >= 0], columns[columns >= 0]] = 1
    return out


def _expect(model: LabelModel, voters: np.ndarray):
    """Sums over documents by class: how many, how many silent, and how often two voters fire together."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(voters)
        total = np.zeros((2, size * size + 2))
        for batch in batches:
            for a in range(0, len(batch), 2000):
                votes = _votes(batch["held"].iloc[a: a + 2000], voters)
                toxic = model.posterior(votes)
                silent = ~votes.any(axis=1)
                for c, p in enumerate((1 - toxic, toxic)):
                    fired = votes[~silent]
                    total[c, :-2] += ((fired * p[~silent, None]).T @ fired).ravel()
                    total[c, -2:] += p.sum(), p[silent].sum()
        c, cell = np.nonzero(total)
        yield pd.DataFrame({"c": c.astype(np.int32), "cell": cell.astype(np.int32), "amount": total[c, cell]})
    return run


def fit_label_model(held: DataFrame, start: LabelModel, voters: np.ndarray,
                    rounds: int = EM_ROUNDS) -> tuple[LabelModel, np.ndarray]:
    """The model and the voters it keeps, by expectation-maximization over all documents; only sums by pairs of voters
    reach the driver. After the first round a voter goes if a better one repeats it within the toxic class."""
    model = start
    for turn in range(rounds):
        size = len(voters)
        sums = (held.select("held").mapInPandas(_expect(model, voters), "c int, cell int, amount double")
                .groupBy("c", "cell").agg(F.sum("amount").alias("amount")).collect())
        total = np.zeros((2, size * size + 2))
        for row in sums:
            total[row["c"], row["cell"]] = row["amount"]
        n, silent = total[:, -2], total[:, -1]
        pairs = total[:, :-2].reshape(2, size, size)
        rates = np.clip((np.diagonal(pairs, axis1=1, axis2=2) + 0.05) / (n[:, None] + 1), 1e-7, 1 - 1e-7)
        p = rates[1]  # within the toxic class: correlation of two voters beyond their rates
        spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
        phi = np.clip((pairs[1] / max(n[1], 1e-9) - np.outer(p, p)) / np.maximum(spread, 1e-9), 0, 1)
        np.fill_diagonal(phi, 0)
        if turn == 0:
            kept: list[int] = []
            for i in range(size):
                if not kept or phi[i, kept].max() < REPEATED:
                    kept.append(i)
            voters, rates, phi = voters[kept], rates[:, kept], phi[np.ix_(kept, kept)]
        phi[phi < CORRELATED] = 0
        model = LabelModel(start.share, rates[1], np.minimum(rates[0], rates[1]), 1 / (1 + phi.sum(axis=1)),
                           (silent[1] + 0.05) / (n[1] + 1), (silent[0] + 0.05) / (n[0] + 1))
    return model, voters


def fit_linear(held: list[np.ndarray], target: np.ndarray, size: int, rounds: int = 600, ridge: float = 1e-5) -> np.ndarray:
    """Logistic regression on 0/1 terms with soft labels; the last weight is the intercept."""
    lengths = np.array([len(h) for h in held])
    columns = np.concatenate([np.asarray(h, np.int64) for h in held] or [np.zeros(0, np.int64)])
    rows = np.repeat(np.arange(len(held)), lengths)
    n = max(len(held), 1)
    # step sizes by how often a term occurs (a bound on the curvature, times the length of rows)
    curvature = np.append(np.bincount(columns, minlength=size), n) / n * 0.25 * (1 + np.sqrt(lengths.mean() if n else 0)) + 0.003
    w, v = np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = np.log(max(target.mean(), 1e-6) / max(1 - target.mean(), 1e-6))
    v[:] = w
    for turn in range(rounds):
        odds = np.bincount(rows, weights=v[columns], minlength=len(held)) + v[-1]
        miss = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target
        slope = np.append(np.bincount(columns, weights=miss[rows], minlength=size), miss.sum()) / n
        slope[:-1] += ridge * v[:-1]
        new = v - slope / curvature
        v = new + turn / (turn + 3) * (new - w)
        w = new
    return w


def _score(weights: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odds = np.array([weights[-1] + weights[np.asarray(h, np.int64)].sum() for h in batch["held"]])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "score": 1 / (1 + np.exp(-np.clip(odds, -30, 30)))})
    return run


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on) and text_hash of every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"),  # ids may be null
                       F.xxhash64(text_col).alias("text_hash"))
    known = (labels.select(F.col(id_col).cast("string").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(~is_held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    # at most max_labelled ids and labels
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    chosen = staged(chosen, "labelled")
    sample = rows.join(F.broadcast(chosen), "doc_id")
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_clean, n_toxic = counts.get(0, 0), counts.get(1, 0)
    share = n_toxic / max(n_clean + n_toxic, 1)
    mined = mine_terms(sample.select("text", "label"), n_clean, n_toxic) if n_clean and n_toxic else []
    if not mined:
        return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), is_held_out("doc_id").alias("held_out"),
                           F.lit(float(share)).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"), "text_hash")
    clean = np.array([(m[1] + 0.5) / (n_clean + 1) for m in mined])
    toxic = np.array([(m[2] + 0.5) / (n_toxic + 1) for m in mined])
    voters = np.flatnonzero((toxic / clean >= MIN_LIFT) & (np.array([m[2] for m in mined]) >= max(MIN_SUPPORT, VOTER_SHARE * n_toxic)))[:MAX_VOTERS]
    held = staged(rows.mapInPandas(released(_hold([m[0] for m in mined])), "doc_id string, text_hash bigint, held array<int>"), "terms")

    picked = held.join(F.broadcast(chosen), "doc_id").select("held", "label").toPandas()  # at most max_labelled rows
    training = [np.asarray(h, np.int64) for h in picked["held"]]
    target = picked["label"].to_numpy(float)
    if len(voters):
        start = LabelModel(share, toxic[voters], clean[voters], np.full(len(voters), 0.5), 0.2, 0.9)
        model, voters = fit_label_model(held, start, voters)
        voted = np.concatenate([model.posterior(_votes(picked["held"].iloc[a: a + 5000], voters))
                                for a in range(0, len(picked), 5000)])
        odds = np.log(voted / (1 - voted)) + (2 * target - 1) * np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
        target = 1 / (1 + np.exp(-odds))  # the given label is one more voter
    weights = fit_linear(training, target, len(mined))
    scored = held.mapInPandas(_score(weights), "doc_id string, text_hash bigint, score double")
    return scored.select(F.col("doc_id").cast("bigint").alias("doc_id"), is_held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_hash")
