"""The llm operators on small fixtures with every awkward row, against brute force or their SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (catalogue, decontaminate, encoder, html_text, ngram_join, packing, quality_model, quality_rules,
                          signature_tree, substrings, tables, token_counts, token_store, toxicity, wordhash)
from tidemark.llm.components import connected_components

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, tag string, n int, h string, "
          "item int, label int, stratum string, cluster int, `_id` int")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BYTE, WORD = catalogue.tokenizer_path("byte_bpe_50k.json"), catalogue.tokenizer_path("word_bpe_49k.json")


def words_of(text):
    return WORDS.findall(text or "")


def lines(n, seed):
    dice = random.Random(seed)
    return " ".join(dice.choice("Alpha beta gamma DELTA epsilon zeta eta theta iota kappa lambda mu é 日本 x!".split()) + str(dice.randrange(400))
                    for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Null in any column, empty and very long texts, ties, repeated rows, one id with two texts, clashing columns."""
    base, other = lines(120, 1), lines(90, 2)
    near = base.split()
    near[60] = "changed"
    texts = [(1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "one"),
             (9, other), (9, base + " " + other), (None, base), (None, None), (10, lines(40, 3) + "\n" + " ".join(base.split()[10:75])),
             (11, lines(30_000, 4)), (12, "two words"), (2**60 + 1, other), (13, "a|b ### <|endoftext|> " * 30), (14, "word " * 200)]
    rows = [(d, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", None if k % 5 == 0 else len(t or ""),
             k, "x", 1, "h", 2, 1, None, 3, 4) for k, (d, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (3, 1, 0), (None, 1, 1), (9, None, None), (14, 0, 1)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def medium_labels():
    import duckdb
    return duckdb.sql(f"SELECT * FROM '{MEDIUM}/labels.parquet'").df()


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SMALL), SMALL, catalogue.QUERIES[name], catalogue.ORACLE[name]) == []


def test_words_and_shingles_are_told_apart_by_hash():
    texts = [None, "", " a ", "A b\x0bc\n\nd", "é É x", lines(300, 5)]
    for lower in (False, True):
        seen: dict = {}
        for begin, end, words in wordhash.each_words(pd.Series(texts), lower, limit=40):
            shingles, where = wordhash.shingles_of(words, 3)
            for i in range(begin, end):
                own = words_of(texts[i].translate(LOWER) if lower and texts[i] else texts[i])
                wanted = [tuple(own[j:j + 3]) for j in range(len(own) - 2)] if len(own) > 2 else [tuple(own)] * bool(own)
                got = shingles[where[i - begin]: where[i - begin + 1]].tolist()
                assert len(got) == len(wanted)
                assert all(seen.setdefault(w, g) == g for w, g in zip(wanted, got))
        assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_library(path):
    texts = [None, "", " ", "a  b\n c", "don't 's", "日本 語　全角", "é é", "a <|endoftext|> b", "x\u0085y \xa0z", "ΑΣ ΣΑΣ",
             "1 234,5", lines(500, 6), " lead", "trail ", "😀 😀"]
    own = encoder.Encoder(path, offsets=True)
    for begin, end, ids, where, spans in own.each(pd.Series(texts), 200):
        for i in range(begin, end):
            wanted = own.plain.encode(texts[i] or "", add_special_tokens=False)
            part = slice(where[i - begin], where[i - begin + 1])
            assert ids[part].tolist() == wanted.ids
            assert [tuple(s) for s in spans[part].tolist()] == wanted.offsets


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_special_tokens_as_in_an_unaltered_library(path):
    from tokenizers import Tokenizer
    library, dice = Tokenizer.from_file(path), random.Random(8)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "<", "|endoftext|>", " ", " ", "  ", "    ", "\n", "a", "Bc", "é", "\u0338",
             "'s", "12"]
    texts = ["a <|endoftext|> b", "a     <|endoftext|>", "<|endoftext|><|startoftext|>", "ends in spaces     ", "x", None, " " * 9, "y"]
    texts += ["".join(dice.choice(parts) for _ in range(dice.randrange(14))) for _ in range(2000)]
    own = encoder.Encoder(path, offsets=True)
    fast = encoder.Encoder(path)
    for limit in (60, 1 << 20):
        for (begin, end, ids, where, spans), (*_, same, _, _) in zip(own.each(pd.Series(texts), limit), fast.each(pd.Series(texts), limit)):
            assert ids.tolist() == same.tolist()
            for i in range(begin, end):
                wanted = library.encode(texts[i] or "", add_special_tokens=False)
                part = slice(where[i - begin], where[i - begin + 1])
                assert (ids[part].tolist(), [tuple(s) for s in spans[part].tolist()]) == (wanted.ids, wanted.offsets), texts[i]
    first = {BYTE: [64, 220, 50256, 275], WORD: [320, 49407, 321]}[path]
    assert own.encode(*wordhash.buffer_of(pd.Series(texts[:1])))[0].tolist() == first


# 1 -----------------------------------------------------------------------------------------------------------------
def test_minimum_cut_is_minimal():
    dice = random.Random(1)
    for _ in range(150):
        n = dice.randrange(1, 8)
        scores = [dice.choice([-2, -1, 0, 1.5, 3]) * dice.random() for _ in range(n)]
        edges = [(i, j, dice.random()) for i in range(n) for j in range(i) if dice.random() < 0.5]

        def cost(keep):
            return (sum(abs(s) for s, k in zip(scores, keep) if (s > 0) != bool(k) and s)
                    + sum(w for i, j, w in edges if keep[i] != keep[j]))
        assert cost(html_text.min_cut(scores, edges)) == pytest.approx(min(map(cost, itertools.product([0, 1], repeat=n))))


def test_main_text_leaves_boilerplate():
    page = """<!DOCTYPE html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies to make
      this site better for everybody who reads it, as you may well know by now.</p></div><aside><p>Popular things</p></aside>
      <article><h1>Title &amp; more</h1><p><b>One\n two&nbsp;three<br>four<p>Next <i>par</i>agraph</p><div class="ad">Buy now</div>
      <form><label>Mail</label><button>Go</button></form><section class="comments"><p>A long comment of a reader who liked it, and
      says so at length, in many words, so that it looks like text.</p></section></article><footer><p>&copy; us</p></footer>"""
    assert html_text.main_text(page) == "Title & more\nOne two three four\nNext paragraph"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>Menu</nav>") == ""


@pytest.mark.parametrize("page,text", [
    ("<head><title>T</title><meta name=a><body><p>After a head</p>", "After a head"),
    ("<html><head><title>T</title><script>x='<p>no</p>'</script><div><p>No body tag</p></div>", "No body tag"),
    ("<head><title>T<body><p>No end of the title</p>", "No end of the title"),
    ("<head><noscript><link></noscript><noscript><link><body><p>Noscript in a head</p>", "Noscript in a head"),
    ("<div><iframe src=x></div><p>After an iframe</p>", "After an iframe"),
    ("<div><noscript>Turn it on<p>now</div><p>After noscript</p><noscript><p>No</p></noscript>", "After noscript"),
    ("<div><object><param></div><p>After an object</p>", "After an object"),
    ("<form><textarea></form><p>After a textarea</p>", "After a textarea"),
    ("<p>One<noscript>no<p>Two</p>", "One\nTwo"),
    ("<p>One<svg class='x'/> two <math/>three</p><p>Four<svg><path d='x'/></svg></p>", "One two three\nFour"),
    ("<p>One <svg><g><p>Two</p>", "One\nTwo"),
    ("<p>One <svg><foreignObject><div>no</div></foreignObject><svg><g/></svg>no<title>no</title></svg>two</p>", "One two"),
    ("<p>One <object><p>no</p><object>no</object>no</object>two</p>", "One two"),
    ("<p>One <template><div>no</div><template>no</template>no</template>two</p>", "One two"),
    ("<p>One</p><script>if (a) { x = '<p>no</p>'", "One"),
])
def test_elements_without_text_end(page, text):
    assert "\n".join(b.text for b in html_text.blocks_of(page)) == text


_ARTICLE = "<h1>The title</h1><p>First paragraph of the piece, without any links.</p><p>Second one, as plain as the first.</p>"
_TEXT = "The title\nFirst paragraph of the piece, without any links.\nSecond one, as plain as the first."
_MENU, _SIDE = "<nav><a href=a>Home</a></nav>", "<div class='sidebar'><p>Popular this week</p></div><footer>Imprint</footer>"


@pytest.mark.parametrize("page", [
    f"<body class='single has-sidebar'>{_MENU}<article>{_ARTICLE}</article>{_SIDE}",
    f"<body>{_MENU}<div class='content with-sidebar'>{_ARTICLE}</div>{_SIDE}",
    f"<body class='header-fixed nav sidebar'>{_MENU}<main>{_ARTICLE}</main>{_SIDE}",
    f"<body>{_MENU}<article class='post category-alert'>{_ARTICLE}</article>{_SIDE}",
    f"<body>{_MENU}<div id='legal-news'>{_ARTICLE}</div>{_SIDE}",
    f"<body><form id=all>{_MENU}<div>{_ARTICLE}</div>{_SIDE}</form>",
    f"<body>{_MENU}<article><header class='entry-header'><h1>The title</h1></header>{_ARTICLE[18:]}</article>{_SIDE}",
    f"<body>{_MENU}<div class='post'><header class='entry-header'><h1>The title</h1></header>{_ARTICLE[18:]}</div>{_SIDE}",
    f"<body>{_MENU}<div class='sidebar'><article>{_ARTICLE}</article></div>{_SIDE}",
    f"<body>{_MENU}<article>{_ARTICLE}</article><div id='comment-section'><p>{'A long comment by a reader. ' * 30}</p></div>",
    f"<body>{_MENU}<article>{_ARTICLE}</article><div class='comments'><article class='comment'><p>{'A reader. ' * 90}</p></article></div>",
    f"<body>{_MENU}<article>{_ARTICLE}</article><div class='related'><article class='card'><h3>Other</h3><p>Teaser</p></article></div>",
    f"<body>{_MENU}<div>{_ARTICLE}</div>{_SIDE}<form><p>Your name</p><button>Go</button></form>",
])
def test_containers_that_hold_the_article_are_no_noise(page):
    assert html_text.main_text(page) == _TEXT


def test_cut_changes_labels_both_ways():
    link = "<p><a href=x>A line that is only a link</a></p>"
    plain = "<p>" + "An ordinary paragraph that goes on for a while. " * 5 + "</p>"
    stray = "<p>Words between links, of a length that a short paragraph may have.</p>"
    for page, label in ((f"<div>{plain}{link}{plain}</div>", True), (f"<div>{link}{stray}{link}</div>", False)):
        blocks = html_text.blocks_of(page)
        assert (blocks[1].score > 0) != label
        assert html_text.min_cut([b.score for b in blocks], html_text.smoothness(blocks))[1] == label


def test_a_form_or_sidebar_alone_is_no_article():
    assert html_text.main_text("<form><p>Your name</p></form>") == ""
    assert html_text.main_text("<div class=sidebar><p>Text of a sidebar that stands alone on its page</p></div>") == ""


def test_pages_with_awkward_rows(spark):
    long_page = "<article>" + "<p>text of a paragraph</p>" * 3000 + "</article>"
    pages = spark.createDataFrame(
        [(1, "u", "<article><p>Good text</p></article>", "z"), (1, "u", "<article><p>Good text</p></article>", "z"), (None, None, None, None),
         (2, "v", "", "z"), (3, "w", long_page, "z")], "page_id bigint, url string, html string, text string")
    out = [(r.page_id, r.text, r.n_chars) for r in html_text.extract_pages(pages).collect()]
    assert Counter(out) == Counter([(1, "Good text", 9)] * 2 + [(None, "", 0), (2, "", 0), (
        3, "\n".join(["text of a paragraph"] * 3000), 20 * 3000 - 1)])
    assert html_text.extract_pages(pages.limit(0)).count() == 0


# 2, 3 --------------------------------------------------------------------------------------------------------------
def _auc(rows, labels, name):
    both = rows.merge(labels.dropna(), on="doc_id").query("held_out")
    rank, y = both["score"].rank(), both[name] == 1
    return (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum()), (both["predicted"] == both[name]).mean()


def test_toxicity_on_held_out_rows(spark, medium_labels):
    auc, accuracy = _auc(catalogue.QUERIES["op2_toxicity"](spark, MEDIUM).toPandas(), medium_labels, "toxic")
    assert auc > 0.95 and accuracy > 0.98


def test_quality_on_held_out_rows(spark, medium_labels):
    auc, accuracy = _auc(catalogue.QUERIES["op3_quality_classifier"](spark, MEDIUM).toPandas(), medium_labels, "quality")
    assert auc > 0.98 and accuracy > 0.96


@pytest.mark.parametrize("score", [toxicity.score_documents, quality_model.score_documents])
def test_scores_of_awkward_rows(score, awkward, nothing, labels):
    frame = score(awkward, labels)
    assert Counter(r.doc_id for r in frame.collect()) == Counter(r.doc_id for r in awkward.select("doc_id").collect())
    out = frame.toPandas()
    assert len(out) == awkward.count() and out["score"].between(0, 1).all() and out["predicted"].isin([0, 1]).all()
    assert score(awkward, labels.limit(0)).toPandas()["score"].between(0, 1).all()
    assert score(nothing, labels).count() == 0


def test_held_out_rows_follow_the_checksum(spark):
    ids = spark.range(200).select(F.col("id").alias("doc_id")).withColumn("held", toxicity.is_held_out("doc_id")).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in ids)


# 4 -----------------------------------------------------------------------------------------------------------------
def test_token_counts_by_rule(awkward, nothing):
    plain = encoder.Encoder(BYTE).plain
    for rule in token_counts.RULES:
        got = Counter()
        for r in token_counts.count_tokens(awkward, BYTE, rule=rule).collect():
            got[r.doc_id, r.section] += r.n_tokens
        wanted = Counter()
        for r in awkward.collect():
            if not r.text:
                continue
            sections = token_counts.line_sections(r.text)
            wanted.update({(r.doc_id, s): 0 for s in range(len(sections))})
            for a, b in plain.encode(r.text, add_special_tokens=False).offsets:
                shares = [max(0, min(max(b, a + 1), e) - max(a, s)) for s, e in sections]
                inside = [s for s, share in enumerate(shares) if share]
                pick = {"start": inside[:1], "end": inside[-1:], "majority": [int(np.argmax(shares))] if inside else []}[rule]
                wanted[r.doc_id, pick[0] if pick else -1] += 1
        assert got == wanted
    assert token_counts.count_tokens(nothing, BYTE).count() == 0


def test_crossing_tokens_by_rule():
    spans, sections = np.array([[0, 3], [2, 6], [9, 10], [4, 8]]), np.array([[0, 3], [3, 9]])
    assert token_counts.attribute(spans, sections, "start").tolist() == [0, 0, -1, 1]
    assert token_counts.attribute(spans, sections, "end").tolist() == [0, 1, -1, 1]
    assert token_counts.attribute(spans, sections, "majority").tolist() == [0, 1, -1, 1]


# 5 -----------------------------------------------------------------------------------------------------------------
def test_decontamination_finds_items_in_awkward_rows(spark, awkward, nothing):
    base = lines(120, 1).split()
    items = spark.createDataFrame([(1, " ".join(base[20:60])), (1, " ".join(base[20:60])), (2, None), (3, ""), (4, "TWO, words!"),
                                   (None, "no such item in any of the documents"), (5, " ".join(base[30:40] + ["new"] + base[40:60]))],
                                  "item_id bigint, text string")
    out = [(r.id, r.contaminated, r.first_item) for r in decontaminate.mark_documents(awkward, items).collect()]
    wanted = []
    for r in awkward.collect():
        text = " ".join(re.findall(r"[^\W_]+|[^\x00-\x7f]+", (r.text or "").lower()))
        held = [k for k, part in ((1, " ".join(base[20:60])), (4, "two words")) if
                " ".join(re.findall(r"[^\W_]+|[^\x00-\x7f]+", part.lower())) in text]
        wanted.append((r.doc_id, bool(held), min(held, default=None)))
    assert Counter(out) == Counter(wanted)
    assert sum(c for _, c, _ in wanted) >= 6
    assert not any(r.contaminated for r in decontaminate.mark_documents(awkward, items.limit(0)).collect())
    assert decontaminate.mark_documents(nothing, items).count() == 0


# 6 -----------------------------------------------------------------------------------------------------------------
def brute_classes(rows, k, percent):
    sets = []
    for _, text in rows:
        w = words_of((text or "").translate(LOWER))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a
    for (a, s), (b, t) in itertools.combinations([(i, s) for (i, _), s in zip(rows, sets) if s and i is not None], 2):
        overlap = len(s & t)
        if a != b and 100 * overlap >= percent * (len(s) + len(t) - overlap):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return Counter((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets))


def test_classes_of_awkward_rows(awkward, nothing):
    for k, percent in ((4, 85), (5, 80)):
        got = Counter(map(tuple, ngram_join.jaccard_classes(awkward, k=k, percent=percent).collect()))
        assert got == brute_classes([(r.doc_id, r.text) for r in awkward.collect()], k, percent)
    assert ngram_join.jaccard_classes(nothing).count() == 0


@pytest.mark.parametrize("chunked", [False, True])
def test_classes_of_random_copies(spark, monkeypatch, chunked):
    if chunked:  # cut groups and clusters of a few documents
        monkeypatch.setattr(ngram_join, "GROUP", 6)
        monkeypatch.setattr(ngram_join, "CLUSTER", 4)
        monkeypatch.setattr(ngram_join, "HUBS", 2)
    dice, rows = random.Random(7), []
    for family in range(4):
        base = lines(80 + 20 * family, 100 + family).split()
        for _ in range(22):
            own = list(base)
            for _ in range(dice.choice([0, 0, 1, 1, 2, 3])):
                own[dice.randrange(len(own))] = f"edit{dice.randrange(5)}"
            rows.append((len(rows), " ".join(own[: len(own) - dice.choice([0, 0, 3])])))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, ngram_join.jaccard_classes(frame).collect())) == brute_classes(rows, 4, 85)


@pytest.mark.parametrize("chunked", [False, True])
def test_ids_in_clusters_with_rows_without_words(spark, monkeypatch, chunked):
    if chunked:
        monkeypatch.setattr(ngram_join, "GROUP", 6)
        monkeypatch.setattr(ngram_join, "CLUSTER", 4)
        monkeypatch.setattr(ngram_join, "HUBS", 2)
    base, dice, rows = lines(100, 31).split(), random.Random(4), []
    for i in range(16):
        own = list(base)
        for _ in range(dice.choice([0, 1, 1, 3, 4])):
            own[dice.randrange(len(own))] = f"edit{i}"
        rows += [(i, " ".join(own)), (i, [None, "", " \n\t "][i % 3])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, ngram_join.jaccard_classes(frame).collect())) == brute_classes(rows, 4, 85)


def test_cluster_without_words_has_no_links():
    group = pd.DataFrame({"id": [1, 2, 3, 3], "text": [lines(50, 1), lines(50, 1), None, ""], "outer": [False, False, True, True]})
    link = ngram_join._link_cluster(4, 85, True)
    assert len(link(group)) == 0 and len(link(group[2:])) == 0
    assert link(group.assign(outer=False)).to_numpy().tolist() in ([[1, 2]], [[2, 1]])


def test_tree_finds_all_links():
    dice = np.random.default_rng(3)
    base = dice.integers(0, 1 << 40, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([dice.choice(base, dice.integers(60, 300), replace=False),
                                      dice.integers(0, 1 << 40, dice.integers(0, 20), dtype=np.uint64)])) for _ in range(60)]
    sizes = np.array([len(s) for s in sets])
    bits = np.stack([signature_tree.bits_of(s, 512) for s in sets])
    order = signature_tree.order_for_tree(sizes, np.array([s[0] for s in sets]))
    tree, forest = signature_tree.SignatureTree(bits[order], sizes[order]), signature_tree.Forest(60)
    signature_tree.dual_traversal(tree, tree, 70, forest, lambda i, j: ngram_join.linked(sets[order[i]], sets[order[j]], 70))
    other = signature_tree.Forest(60)
    for i, j in itertools.combinations(range(60), 2):
        if ngram_join.linked(sets[order[i]], sets[order[j]], 70):
            other.join(i, j)
    assert [forest.find(i) for i in range(60)] == [other.find(i) for i in range(60)]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, 200 + i) for i in range(60)] + [(300, 300), (7, 8), (8, 7), (8, 9)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    wanted = {**{i: 100 for i in range(100, 141)}, **{200 + i: 5 for i in range(60)}, 5: 5, 7: 7, 8: 7, 9: 7}
    assert got == wanted


# 7 -----------------------------------------------------------------------------------------------------------------
def brute_repeats(rows, window):
    first: dict = {}
    for i, text in rows:
        w = words_of(text)
        for a in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[a:a + window])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, text in rows:
        w = words_of(text)
        gone = {p for a in range(len(w) - window + 1) if i is not None and first[tuple(w[a:a + window])] < i for p in range(a, a + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def digest(frame):
    return Counter((r.id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest() if r.n_removed else r.sha.hex())
                   for r in frame.collect())


def test_repeats_of_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert digest(substrings.find_repeats(awkward)) == brute_repeats(rows, 50)
    assert substrings.find_repeats(nothing).count() == 0
    cut = substrings.drop_repeats(awkward)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    assert Counter((r.doc_id, len(words_of(r.text))) for r in cut.collect()) == Counter(
        (i, n - gone) for (i, n, gone, _), times in brute_repeats(rows, 50).items() for _ in range(times))


def test_repeats_of_random_texts(spark):
    dice, rows = random.Random(5), []
    pool = [f"w{i}" for i in range(6)]
    for i in range(60):
        own = [dice.choice(pool) for _ in range(dice.randrange(0, 40))]
        if rows and dice.random() < 0.6:
            other = words_of(dice.choice(rows)[1])
            a = dice.randrange(0, max(1, len(other) - 5))
            own[dice.randrange(0, len(own) + 1):0] = other[a: a + dice.randrange(5, 25)]
        rows.append((dice.randrange(40), " ".join(own)))
    got = digest(substrings.find_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), window=10, seed=4))
    assert got == brute_repeats(rows, 10)


@pytest.mark.parametrize("width", [1, 2, 7, 30])
def test_winnowing_marks_every_window(width):
    dice = np.random.default_rng(width)
    for n in (0, 1, width - 1, width, 60):
        hashes = dice.integers(0, 8, n, dtype=np.uint64)
        marked = set(substrings.winnow(hashes, width).tolist())
        for a in range(n - width + 1):
            least = hashes[a: a + width].min()
            assert any(a <= p < a + width and hashes[p] == least for p in marked)


# 8 -----------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003).astype("<u4")
    raw = token_store.pack_bits(ids, bits)
    assert len(raw) == -(-1003 * bits // 8)
    assert (token_store.unpack_bits(raw, bits, 1003) == ids).all()


def test_files_give_random_access(tmp_path):
    dice, path = np.random.default_rng(1), str(tmp_path / "x.ids")
    writer = token_store.StoreWriter(path, token_store.bits_for(49_408), block_ids=100)
    docs = [dice.integers(0, 49_408, n).astype(np.int32) for n in (0, 1, 99, 100, 101, 1000, 5)]
    for part in (docs[:3], docs[3:]):
        writer.add([None, *range(len(part) - 1)], np.concatenate(part), np.cumsum([0, *map(len, part)]))
    writer.close()
    reader = token_store.StoreReader(path)
    assert reader.bits == 16 and reader.null.tolist() == [True, False, False, True, False, False, False]
    assert all((reader.document(i) == docs[i]).all() for i in range(7))
    whole = np.concatenate(docs)
    for a, b in ((0, 0), (5, 6), (99, 101), (250, 777), (0, len(whole))):
        assert (reader.ids(a, b) == whole[a:b]).all()


def test_store_of_awkward_rows(awkward, nothing):
    plain = encoder.Encoder(WORD).plain
    out = token_store.read_digests(token_store.write_tokens(awkward, WORD, 49_408, 1)).collect()
    wanted = Counter()
    for r in awkward.collect():
        ids = np.array(plain.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        wanted[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == wanted
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(out, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert token_store.read_digests(token_store.write_tokens(nothing, WORD, 49_408, 1)).count() == 0


def test_equal_rows_spread_over_files(spark, monkeypatch):
    monkeypatch.setattr(token_store, "FILE_BYTES", 1000)
    same = spark.range(2000).selectExpr("CAST(3 AS BIGINT) AS doc_id", "'some words here' AS text")
    manifest = token_store.write_tokens(same, WORD, 49_408, 1)
    files = manifest.collect()
    assert len(files) > 20 and max(f.n_docs for f in files) < 400 and sum(f.n_docs for f in files) == 2000
    out = token_store.read_digests(manifest).collect()
    assert sorted(r.start for r in out) == [i * out[0].n_tokens for i in range(2000)]


# 9 -----------------------------------------------------------------------------------------------------------------
def test_measures_of_awkward_rows(awkward, nothing, labels):
    for r in quality_rules.measures(awkward.drop("n")).collect():
        w = words_of(r.text)
        own = [x for x in (r.text or "").split("\n") if words_of(x)]
        windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        covered = {p for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for p in range(i, i + 3)}
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.n_symbols) == (
            len(w), sum(map(len, w)), len(own) - len(set(own)), len(covered), len(re.findall(r"[#*$%&|<>]", r.text or "")))
    out = quality_rules.judge(awkward, labels)
    assert out.count() == awkward.count() and out.filter("kept AND base_failed").count() == 0
    assert out.filter("kept IS NULL OR base_failed IS NULL").count() == 0
    assert quality_rules.judge(nothing, labels).count() == 0


def test_cutoffs_keep_their_promise(spark):
    """A rule that one good document in 500 breaks is used at that cutoff; one that one in 50 breaks is not."""
    rows = [("a", 1000, 5000, 600 if i % 50 == 0 else 150 if i % 4 else 0, 0, 100, 300 if i % 500 == 0 else 0) for i in range(6000)]
    frame = spark.createDataFrame(rows, "stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long")
    cut = {r.rule: r.cutoff for r in quality_rules.select_cutoffs(frame).collect()}
    assert cut["repeat_word_share"] == 0.05 and cut["symbols_per_word"] == 0.75 and cut["dup_line_share"] == 0.05
    assert quality_rules.select_cutoffs(frame.limit(50)).count() == 0


@pytest.mark.parametrize("k,n", [(0, 10), (3, 40), (25, 3000), (40, 20_000)])
def test_binomial_tail_is_exact(spark, k, n):
    from fractions import Fraction
    from math import comb
    wanted = float(sum(Fraction(comb(n, i)) * Fraction(1, 200) ** i * Fraction(199, 200) ** (n - i) for i in range(k + 1)))
    row = spark.createDataFrame([(k, n)], "k bigint, n bigint").select(quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.005)).first()
    assert row[0] == pytest.approx(wanted, rel=1e-9)


# 10 ----------------------------------------------------------------------------------------------------------------
def test_packing_of_awkward_rows(awkward, nothing):
    plain = encoder.Encoder(BYTE).plain
    frame = packing.pack_documents(awkward, BYTE)
    wanted = Counter()
    for r in awkward.collect():
        ids = np.array(plain.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for piece, length in enumerate(packing.piece_lengths(len(ids), 1024)):
            wanted[r.doc_id, piece, at, length, zlib.crc32(ids[at: at + length].tobytes())] += 1
            at += length
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in frame.collect()) == wanted
    out = frame.toPandas()
    for _, own in out.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() <= 1024
    assert packing.pack_documents(nothing, BYTE).count() == 0


def test_bounds_and_exchange(spark):
    dice = np.random.default_rng(2)
    for _ in range(40):
        lengths = dice.integers(1, 13, dice.integers(1, 9))
        bound = packing.lower_bound(np.bincount(lengths, minlength=13), 12)
        for fit in (packing.best_fit_decreasing, packing.completing_fit):
            bins, offsets, fill = fit(lengths, 12)
            assert (np.bincount(bins, weights=lengths) == fill).all() and fill.max() <= 12
            for b in range(len(fill)):
                own = np.flatnonzero(bins == b)
                own = own[np.argsort(offsets[own])]
                assert offsets[own].tolist() == [0, *np.cumsum(lengths[own])[:-1]]
        best = next(b for b in range(1, 10) if any(
            all(sum(x for x, c in zip(lengths, choice) if c == i) <= 12 for i in range(b))
            for choice in itertools.product(range(b), repeat=len(lengths)))) if len(lengths) < 7 else len(fill)
        assert bound <= best <= len(fill)
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(dice.integers(1, 700, 3000))]
    pieces = spark.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    out = packing.pack_pieces(pieces, group_pieces=300)
    bound = packing.lower_bound(np.bincount([r[3] for r in rows], minlength=1025), 1024)
    assert out.count() == 3000 and bound <= out.select("sequence_id").distinct().count() <= bound + 6


def test_equal_pieces_are_spread_over_partitions(spark):
    pieces = spark.range(3000).selectExpr("CAST(7 AS BIGINT) AS doc_id", "0 AS piece", "0L AS start", "400L AS length", "5L AS ids_crc32")
    out = packing.pack_pieces(pieces, group_pieces=300)
    groups = [r["count"] for r in out.groupBy(F.shiftright("sequence_id", 32).alias("grp")).count().collect()]
    assert out.count() == 3000 and len(groups) >= 10 and max(groups) < 600
    assert out.select("sequence_id").distinct().count() <= 1500 + len(groups)


# pipeline ----------------------------------------------------------------------------------------------------------
def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.staged(stage(spark, docs, SMALL), name)
        assert kept.columns == columns and kept.join(docs, "doc_id", "left_anti").count() == 0
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = {r.doc_id: r.text for r in kept.collect()}
        if name == "near_duplicates":
            assert set(got) == {i for i, n, c in brute_classes(rows, 5, 80) if i == c}
        elif name == "substring_dedup":
            want = {i: (n, gone, h) for i, n, gone, h in brute_repeats(rows, 50)}
            assert set(got) == {i for i, (n, gone, _) in want.items() if gone < n or n == 0}
            assert all(hashlib.sha256(" ".join(words_of(t)).encode()).hexdigest() == want[i][2] for i, t in got.items())
        else:
            assert all(got[i] == t for i, t in rows if i in got)
            if name == "toxicity":
                scored = toxicity.score_documents(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
                assert set(got) == {r.doc_id for r in scored if r.predicted == 0}
            else:
                items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
                assert set(got) == {i for i, t in rows if not any(contains(t, item) for item in items)}
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    from tokenizers import Tokenizer
    plain, places = Tokenizer.from_file(BYTE), {}
    pieces = {}
    for r in packed.collect():
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for r in docs.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]
        own = sorted(pieces.pop(r.doc_id), key=lambda p: p.piece)
        assert [p.start for p in own] == list(itertools.accumulate([0, *[p.length for p in own[:-1]]]))
        assert [p.ids_crc32 for p in own] == [zlib.crc32(np.array(ids[p.start: p.start + p.length], "<u4").tobytes()) for p in own]
        assert sum(p.length for p in own) == len(ids)
    assert not pieces
    for own in places.values():
        own.sort()
        assert sum(n for _, n in own) <= 1024 and [o for o, _ in own] == list(itertools.accumulate([0, *[n for _, n in own[:-1]]]))
    assert 0 < docs.count() < len(texts)


def contains(text, item, k=5, percent=80):
    """Whether a text holds enough of an item's shingles, by sets of words."""
    words, own = ([w.translate(LOWER) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")] for t in (text, item))
    k = min(k, len(own))
    asked = {tuple(own[i: i + k]) for i in range(len(own) - k + 1)} if k else set()
    held = {tuple(words[i: i + k]) for i in range(len(words) - k + 1)}
    return bool(asked) and 100 * len(asked & held) >= percent * len(asked)


def test_without_leaves_out_what_is_named(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("if(id % 50 = 0, NULL, id) AS k", "id AS word", "concat('t', id) AS bits")
    for n_bits in (24, 6):  # a bitmap that tells little leaves the rest to the comparison
        monkeypatch.setattr(tables, "WITHOUT_BITS", n_bits)
        gone = spark.createDataFrame([(7,), (7,), (50,), (51,), (None,), (9999,)], "g bigint")
        kept = tables.without(docs, F.col("k"), gone)
        assert kept.columns == docs.columns and {r.word for r in kept.collect()} == set(range(3000)) - {7, 51} and kept.count() == 2998
        assert tables.without(docs, F.col("k"), gone.limit(0)).count() == 3000


def test_stages_decide_by_row(spark):
    """Rows that share an id or have none: one of each group of near copies stays, and no clean row goes with another."""
    leak = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    base, other = lines(80, 21), lines(80, 22)
    rows = [(5, base), (2, base), (2, other), (None, base), (None, other + " more"), (None, None), (None, None), (7, ""), (3, leak + " " + lines(20, 23)), (3, lines(30, 24)),
            (None, leak)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars int").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(set(rows) - {(5, base), (None, base), (None, other + " more")}) + Counter([(None, None)])
    clean = corpus_pipeline.drop_leaks(spark, docs, SMALL)
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(r for r in rows if not contains(r[1], leak))


def test_items_without_an_id_are_found(spark):
    item = lines(9, 31)
    docs = spark.createDataFrame([(1, "x " + item + " y"), (2, lines(9, 32)), (None, item)], "doc_id bigint, text string")
    for rows in ([(None, item)], [(None, item), (4, item), (4, lines(9, 33))]):
        got = decontaminate.mark_documents(docs, spark.createDataFrame(rows, "item_id bigint, text string")).collect()
        assert {r.id: (r.contaminated, r.n_items, r.first_item) for r in got} == {
            1: (True, len(rows) - (len(rows) > 1), 4 if len(rows) > 1 else None), 2: (False, 0, None),
            None: (True, len(rows) - (len(rows) > 1), 4 if len(rows) > 1 else None)}


def test_pipeline_over_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            docs.write.format("noop").mode("overwrite").save()


def test_pipeline_leaves_no_more_than_rows_behind(spark, awkward, tmp_path):
    """Tables of the near-duplicate join go with it, and shuffles with the table they were made for."""
    folder = Path(tables.new_folder(spark, "x")).parent

    def staged_now():
        return {p.name.rsplit("-", 1)[0]: p for p in folder.iterdir()} if folder.exists() else {}

    def shuffled():
        return {p for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
                for p in Path(d).rglob("shuffle_*")}

    tables.clear(spark)
    kept = corpus_pipeline.drop_near_duplicates(spark, awkward.select("doc_id", "text", "lang", "source", "n_chars"), SMALL)
    assert set(staged_now()) == {"rows", "later"}
    before = kept.count()
    assert kept.count() == before > 0
    was = shuffled()
    tables.staged(awkward.select("doc_id", "n_chars").distinct().groupBy("n_chars").count(), "counted").count()
    for _ in range(50):  # files go in the background
        left = {p for p in shuffled() - was if p.exists()}
        if len(left) <= 1:
            break
        time.sleep(0.2)
    assert len({p.name.split("_")[1] for p in left}) <= 1  # of the count at most
