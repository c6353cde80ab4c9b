"""Quality classifier by co-training.

Two views of a document have a classifier each: its text content (which characters and words it uses, how they repeat)
and its page metadata (source, language, stated length, layout of lines). Both start from a bounded sample of labelled
rows. In every round each view scores all unlabelled documents, and those it is surest of become labelled rows for the
other view, as many of each class as their share among the labels, if the view's calibrated confidence in them is high.
In the end both views are calibrated together on labelled rows that neither was fitted on (of one hash fold), and every
document gets the combined score.

Views are logistic regressions on one-hot bins; bin edges are quantiles over all documents.

Held-out rows (a remainder of the checksum of their id) are never used as labelled or as pseudo-labelled rows.

Defined results: null or empty texts have zero counts, null metadata form a bin of their own, so every row gets a score.
Without labelled rows of both kinds the score is the share of good labels (0 without any). Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import staged
from tidemark.llm.toxicity import fit_linear, is_held_out
from tidemark.llm.wordhash import each_words

#: Labelled rows fitted on at most, rounds, and pseudo-labelled rows a view may hand over in a round at most.
MAX_LABELLED, ROUNDS, MAX_GROWTH = 30_000, 3, 4_000
CONFIDENT, BINS, SOURCES = 0.95, 12, 256
TEXT = ["upper", "digit", "mark", "pipe", "bang", "stop", "high", "word_length", "distinct", "adjacent", "top_word", "words"]
PAGE = ["stated", "lines", "line_length", "longest_line"]
_CLASSES = {  # share of bytes
    "upper": range(65, 91), "digit": range(48, 58), "mark": b"#*$%&<>@^~_=+\\/", "pipe": b"|", "bang": b"!?",
    "stop": b".,;:", "high": range(128, 256)}


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tables = {}
    for name, members in _CLASSES.items():
        tables[name] = np.zeros(256, np.int64)
        tables[name][list(members)] = 1
    for batch in batches:
        for begin, end, words in each_words(batch["text"]):
            starts, n = words.text_starts, end - begin
            size = np.maximum(np.diff(starts), 1)

            def per_text(values: np.ndarray) -> np.ndarray:
                total = np.zeros(len(values) + 1, np.int64)
                np.cumsum(values, out=total[1:])
                return total[starts[1:]] - total[starts[:-1]]

            out = {name: per_text(table[words.data]) / size for name, table in tables.items()}
            after = np.append(False, words.data[:-1] == 0xC3)[: len(words.data)]
            out["upper"] = out["upper"] + per_text(after & (words.data >= 0x80) & (words.data <= 0x9E)) / size
            count = np.diff(words.first)
            some = np.maximum(count, 1)
            lengths = np.append(0, np.cumsum(words.ends - words.begins))
            out["word_length"] = (lengths[words.first[1:]] - lengths[words.first[:-1]]) / some
            same = np.append(0, np.cumsum(np.append(False, words.hashes[1:] == words.hashes[:-1])[: len(words.hashes)]))
            inner = np.minimum(words.first[:-1] + 1, words.first[1:])
            out["adjacent"] = (same[words.first[1:]] - same[inner]) / some
            distinct, top = np.zeros(n), np.zeros(n)
            for i in np.flatnonzero(count):
                _, times = np.unique(words.hashes[words.first[i]: words.first[i + 1]], return_counts=True)
                distinct[i], top[i] = len(times) / np.sqrt(count[i]), times.max() / count[i]
            out |= {"distinct": distinct, "top_word": top, "words": np.log1p(count)}
            breaks = np.flatnonzero(words.data == 10)
            out["lines"] = np.log1p(per_text(words.data == 10))
            out["line_length"] = np.log1p(size / (1 + per_text(words.data == 10)))
            edges = np.unique(np.concatenate([starts, breaks]))
            gaps = np.diff(edges) if len(edges) > 1 else np.zeros(0, np.int64)
            longest = np.zeros(n, np.int64)
            if len(gaps):
                np.maximum.at(longest, np.searchsorted(starts, edges[:-1], side="right") - 1, gaps)
            out["longest_line"] = np.log1p(longest)
            out["stated"] = np.log1p(np.maximum(batch["stated"].iloc[begin:end].fillna(-1).to_numpy(float), -0.5))
            numbers = np.column_stack([out[c] for c in TEXT + PAGE]).astype(np.float32)
            yield pd.DataFrame({"id": batch["id"].iloc[begin:end].to_numpy(), "x": list(numbers),
                                "origin": batch["origin"].iloc[begin:end].to_numpy(np.int32),
                                "tongue": batch["tongue"].iloc[begin:end].to_numpy(np.int32)})


class View:
    """A logistic regression on one-hot bins of some numbers, and of source and language for the page."""

    def __init__(self, edges: list[np.ndarray], columns: list[int], page: bool):
        self.edges, self.columns, self.page = edges, columns, page
        self.size = (BINS + 1) * len(columns) + (SOURCES + 64 if page else 0)
        self.weights = np.zeros(self.size + 1)

    def held(self, rows: pd.DataFrame) -> list[np.ndarray]:
        x = np.stack(rows["x"].to_numpy()) if len(rows) else np.zeros((0, len(TEXT + PAGE)))
        out = [k * (BINS + 1) + np.searchsorted(self.edges[c], x[:, c]) for k, c in enumerate(self.columns)]
        if self.page:
            base = (BINS + 1) * len(self.columns)
            out += [base + rows["origin"].to_numpy(np.int64), base + SOURCES + rows["tongue"].to_numpy(np.int64)]
        return list(np.column_stack(out).astype(np.int64))

    def fit(self, rows: pd.DataFrame, labels: np.ndarray) -> None:
        self.weights = fit_linear(self.held(rows), labels.astype(float), self.size, rounds=200, ridge=1e-3)

    def odds(self, rows: pd.DataFrame) -> np.ndarray:
        if not len(rows):
            return np.zeros(0)
        return self.weights[-1] + self.weights[np.stack(self.held(rows))].sum(axis=1)


def _sigmoid(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def calibrate(odds: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of an intercept and the columns of ``odds`` by Newton's method, held to small steps by a ridge."""
    x = np.column_stack([np.ones(len(odds)), odds])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - labels) + 0.1 * np.append(0, w[1:])
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return w


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", source_col: str = "source", lang_col: str = "lang",
                    length_col: str = "n_chars", max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: good) and predicted (1 from 0.5 on) of every row of ``docs``."""
    rows = docs.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(length_col).cast("double").alias("stated"),
        F.when(F.col(source_col).isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(source_col), F.lit(SOURCES - 1))).cast("int").alias("origin"),
        F.when(F.col(lang_col).isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(lang_col), F.lit(63))).cast("int").alias("tongue"))
    table = staged(rows.mapInPandas(_features, "id string, x array<float>, origin int, tongue int"), "features")
    known = (labels.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("int").alias("label"))
             .filter("id IS NOT NULL AND label IN (0, 1)").filter(~is_held_out("id"))
             .groupBy("id").agg(F.max("label").alias("label")))
    chosen = staged(known.orderBy(F.xxhash64("id"), "id").limit(max_labelled), "labelled")
    sample = table.join(F.broadcast(chosen), "id").toPandas()  # at most max_labelled ids
    good = float(sample["label"].mean()) if len(sample) else 0.0

    def result(scored: DataFrame) -> DataFrame:
        return scored.select(F.col("id").cast("bigint").alias("doc_id"), is_held_out("id").alias("held_out"), "score",
                             (F.col("score") >= 0.5).cast("int").alias("predicted"))

    if not 0 < good < 1:
        return result(table.withColumn("score", F.lit(good)))
    marks = [i / BINS for i in range(1, BINS + 1)]
    numbers = table.select(*[F.col("x")[i].alias(f"x{i}") for i in range(len(TEXT + PAGE))])
    edges = [np.unique(e) for e in numbers.approxQuantile(numbers.columns, marks, 0.005)]
    text = View(edges, list(range(len(TEXT))), False)
    page = View(edges, list(range(len(TEXT), len(TEXT + PAGE))), True)
    fold = pd.util.hash_array(sample["id"].to_numpy().astype(str)) % 5 == 0
    fitted, checked = sample[~fold], sample[fold]
    if fitted["label"].nunique() < 2 or checked["label"].nunique() < 2:
        fitted = checked = sample
    gained = {id(text): [], id(page): []}
    unlabelled = table.filter(~is_held_out("id")).join(F.broadcast(chosen.select("id")), "id", "left_anti")
    for turn in range(rounds + 1):
        for view in (text, page):
            more = gained[id(view)]
            train = pd.concat([fitted, *more], ignore_index=True)
            view.fit(train, train["label"].to_numpy())
        if turn == rounds:
            break
        for view, other in ((text, page), (page, text)):
            scale = calibrate(view.odds(checked)[:, None], checked["label"].to_numpy())

            def sure(batches: Iterator[pd.DataFrame], view=view, scale=scale) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    p = _sigmoid(scale[0] + scale[1] * view.odds(batch))
                    keep = np.maximum(p, 1 - p) >= CONFIDENT
                    yield batch.assign(label=(p >= 0.5).astype(np.int32), trust=np.maximum(p, 1 - p))[keep]

            found = unlabelled.mapInPandas(sure, "id string, x array<float>, origin int, tongue int, label int, trust double")
            parts = [found.filter(F.col("label") == label).orderBy(F.desc("trust"), F.xxhash64("id", F.lit(turn)), "id")
                     .limit(max(1, round(MAX_GROWTH * share))) for label, share in ((0, 1 - good), (1, good))]
            gained[id(other)].append(parts[0].unionByName(parts[1]).toPandas())  # MAX_GROWTH rows
    both = calibrate(np.column_stack([text.odds(checked), page.odds(checked)]), checked["label"].to_numpy())

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odds = both[0] + both[1] * text.odds(batch) + both[2] * page.odds(batch)
            yield pd.DataFrame({"id": batch["id"], "score": _sigmoid(odds)})

    return result(table.mapInPandas(score, "id string, score double"))
