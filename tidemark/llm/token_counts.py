"""Token counts of fields and sections by offset-mapped attribution.

A document is encoded once, as a whole, so that counts add up to what a model would see. The character span of every
token is then joined to the sections of the document by interval. A token that crosses a boundary goes to one section
by an explicit rule:

* ``start``: the section that holds its first character inside any section;
* ``end``: the section that holds its last character inside any section;
* ``majority``: the section that holds most of its characters, the first of equal ones.

Tokens outside every section (such as line breaks between lines) are counted under section -1, so that the counts of a
document add up to its tokens.

Defined results: a null or empty text has no sections, hence no rows. Sections without tokens count 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.encoder import encoder_for

_COUNTS = "doc_id string, section int, begin int, end int, n_tokens bigint"
RULES = ("start", "end", "majority")


def line_sections(text: str) -> np.ndarray:
    """Begin and end of every line that is not empty, in characters."""
    at, out = 0, []
    for line in text.split("\n"):
        if line:
            out.append((at, at + len(line)))
        at += len(line) + 1
    return np.array(out, np.int64).reshape(-1, 2)


def attribute(spans: np.ndarray, sections: np.ndarray, rule: str = "start") -> np.ndarray:
    """The section of each token span, -1 outside all; sections are disjoint and ascending, and no span is empty of text
    unless its begin equals its end (such a token counts where its begin lies)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if not len(sections):
        return np.full(len(spans), -1, np.int64)
    begin, end = spans[:, 0], np.maximum(spans[:, 1], spans[:, 0] + 1)
    first = np.searchsorted(sections[:, 1], begin, side="right")  # the first section that ends after the token begins
    last = np.searchsorted(sections[:, 0], end, side="left") - 1  # the last section that begins before the token ends
    outside = last < first
    chosen = first if rule == "start" else last
    if rule == "majority":
        chosen = first.copy()
        for i in np.flatnonzero(last > first):
            own = sections[first[i]: last[i] + 1]
            chosen[i] = first[i] + int(np.argmax(np.minimum(own[:, 1], end[i]) - np.maximum(own[:, 0], begin[i])))
    return np.where(outside, -1, chosen)


def _count(tokenizer: str, sections_of: Callable[[str], np.ndarray], rule: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_for(tokenizer, offsets=True)
        for batch in batches:
            for begin, end, _, where, spans in encoder.each(batch["text"]):
                docs, parts = [], [np.zeros((0, 4), np.int64)]
                for i in range(begin, end):
                    text = batch["text"].iloc[i]
                    if not text:
                        continue
                    sections = sections_of(text)
                    found = attribute(spans[where[i - begin]: where[i - begin + 1]], sections, rule)
                    counts = np.bincount(found + 1, minlength=len(sections) + 1)
                    rows = np.column_stack([np.arange(-1, len(sections)), np.vstack([[-1, -1], sections]), counts])
                    rows = rows[0 if counts[0] else 1:]
                    docs += [batch["doc_id"].iloc[i]] * len(rows)
                    parts.append(rows)
                yield pd.DataFrame(np.concatenate(parts), columns=["section", "begin", "end", "n_tokens"]).assign(
                    doc_id=pd.Series(docs, dtype=object))
    return run


def count_tokens(docs: DataFrame, tokenizer: str, sections_of: Callable[[str], np.ndarray] = line_sections,
                 rule: str = "start", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every section: doc_id, section (from 0; -1: between sections), begin, end (characters), n_tokens."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(_count(tokenizer, sections_of, rule), _COUNTS).withColumn(
        "doc_id", F.col("doc_id").cast("bigint"))  # as text on the way: pandas has no integers with nulls
