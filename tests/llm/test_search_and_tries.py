"""Toxicity bags, ball-tree search and conversation tries against brute force, on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs, messy  # noqa: F401  (fixtures)
from llm_texts import words

from tidegrid.llm import ball_tree, prefix_trie, subword
from tidegrid.llm import textbatch as tb
from tidegrid.llm.frames import ship

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


# ---- toxicity -------------------------------------------------------------------------------------------------------


def bags_of(texts):
    return subword.bags(*tb.utf8(pa.array(texts, pa.string())))


def test_words_are_cut_into_marked_character_ngrams():
    texts = ["Idiot,", "é¡", "«über»", "...", None, "a b"]
    found = ["idiot", "é¡", "«über»", "a", "b"]
    b = bags_of(texts)
    assert np.diff(b.text_first).tolist() == [1, 1, 1, 0, 0, 1]
    for i, word in enumerate(found):
        n = len(f"<{word}>")
        grams = 1 + sum(max(n - k + 1, 0) for k in (3, 4, 5))
        assert b.bucket_first[b.word[i] + 1] - b.bucket_first[b.word[i]] == grams


def test_shared_ngrams_share_buckets():
    b = bags_of(["stupid stupido"])
    one, other = (set(b.bucket[b.bucket_first[w] : b.bucket_first[w + 1]].tolist()) for w in b.word)
    grams = [{f"<{w}>"[i : i + k] for k in (3, 4, 5) for i in range(len(w) + 3 - k)} for w in ("stupid", "stupido")]
    assert len(one & other) == len(grams[0] & grams[1])


def test_passages_cover_every_word_once():
    b = bags_of([words(1, 7), words(2, 8), words(3, 100), "", words(4, 1)])
    assert np.diff(b.text_first).tolist() == [1, 1, 12, 0, 1]
    assert b.passage_first[0] == 0 and b.passage_first[-1] == len(b.word) == 116
    assert np.diff(b.passage_first).min() >= 1 and np.diff(b.passage_first).max() <= 16


def toxic_texts(n, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        own = words(1000 + i, rng.randint(20, 120)).split(" ")
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(2, len(own) // 20)):
                own[rng.randrange(len(own))] = rng.choice(["worthless", "pathetic", "disgusting"])
        out.append((i, " ".join(own), int(toxic)))
    return out


def test_unseen_misspellings_are_found_and_clean_texts_left_alone():
    rows = toxic_texts(800)
    model = subword.fit(bags_of([r[1] for r in rows]), np.array([r[2] for r in rows]))
    clean = [words(9000 + i, 60) for i in range(50)]
    spoilt = [re.sub(r"(\w+ ){12}", lambda m: f"{m[0]}{('worthlesss', 'patheticc', 'disgustingg')[m.start() % 3]} ", t) for t in clean]
    assert (subword.score(model, bags_of(spoilt)) >= 0.5).mean() > 0.9
    assert (subword.score(model, bags_of(clean)) < 0.5).mean() > 0.95
    again = subword.fit(bags_of([r[1] for r in rows]), np.array([r[2] for r in rows]))
    assert np.array_equal(model.table, again.table) and model[1:] == again[1:]


def test_classify_rows_and_folds(spark, docs, messy):
    rows = messy + [(i + 100, text) for i, text, _ in toxic_texts(120)]
    labels = [(i + 100, y, 0) for i, _, y in toxic_texts(120)] + [(None, 1, 0), (5, None, 0), (100, 1, 0), (100, 1, 0), (1, 0, 0), (777, 1, 0)]
    marked = spark.createDataFrame(labels, "doc_id long, toxic int, score int")
    got = rows_of(subword.classify(docs(rows), marked))
    assert Counter(r[0] for r in got) == Counter(r[0] for r in rows)
    for i, held, score, predicted in got:
        assert 0 <= score <= 1 and predicted == int(score >= 0.5)
        assert held == (zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0)
    assert len({r[2] for r in got if r[0] in (5, 6, 7)}) == 1  # texts without words
    assert rows_of(subword.classify(docs([]), marked)) == []
    assert {r[2] for r in subword.classify(docs(rows), marked.limit(0)).collect()} == {0.5}


# ---- ranked search --------------------------------------------------------------------------------------------------


def ranked(documents, items, top=10):
    found = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in documents]
    n_docs, length = sum(1 for _, c in found if c), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        query, scores = set(TERM.findall((text or "").translate(UPPER))), []
        for i, c in found:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in query if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1)]
    return Counter(out)


def test_terms_are_those_of_the_regular_expression():
    texts = ["Ab-c\x7f d_e9 Éa b 😀x\x00y", None, "", "a a A", "--"]
    text, key, count, n = ball_tree.counted_terms(*tb.utf8(pa.array(texts, pa.string())))
    expected = [Counter(TERM.findall((t or "").translate(UPPER))) for t in texts]
    assert n.tolist() == [sum(c.values()) for c in expected]
    assert [sorted(count[text == i].tolist()) for i in range(len(texts))] == [sorted(c.values()) for c in expected]


def test_search_by_brute_force(spark, docs, messy):
    rng, vocabulary = random.Random(3), words(50, 300).split(" ")
    many = [(1000 + i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(300)]
    rows = messy + many + [(5000, many[3][1]), (5001, many[3][1])]
    items = [(i, many[i * 7][1]) for i in range(20)] + [(1, "Nothing here"), (None, messy[0][1]), (None, None), (50, ""), (51, messy[13][1]), (3, many[3][1])]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(ball_tree.rank(docs(rows), frame))
    assert Counter(got) == ranked([r[:2] for r in rows], items)
    assert rows_of(ball_tree.rank(docs([]), frame)) == []
    assert rows_of(ball_tree.rank(docs(rows), frame.limit(0))) == []


def test_blocks_of_items_give_the_same(spark, docs, messy, monkeypatch):
    items = [(i, text) for i, text, *_ in messy if i is not None and i < 11]
    frame = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(ball_tree, "BLOCK_ITEMS", 3)
    assert Counter(rows_of(ball_tree.rank(docs(messy), frame))) == ranked([r[:2] for r in messy], items)


@st.composite
def corpora(draw):
    terms = draw(st.integers(1, 30))
    documents = draw(st.lists(st.dictionaries(st.integers(0, terms - 1), st.integers(1, 10**10), max_size=8), min_size=1, max_size=60))
    query = draw(st.lists(st.integers(0, terms - 1), min_size=1, unique=True))
    group = draw(st.lists(st.integers(0, 5), min_size=terms, max_size=terms))
    return documents, sorted(query), np.array(group)


def tree_of(documents, group):
    first = np.cumsum([0] + [len(d) for d in documents])
    terms = np.array([t for d in documents for t in sorted(d)], np.int64)
    values = np.array([d[t] for d in documents for t in sorted(d)], np.int64)
    return ball_tree.grow(np.arange(len(documents)), first, terms, values, group)


@settings(max_examples=150, deadline=None)
@given(corpora())
def test_bounds_hold_and_search_is_exact(corpus):
    documents, query, group = corpus
    tree = tree_of(documents, group)
    scores = [sum(d.get(t, 0) for t in query) for d in documents]
    bound = ball_tree.bounds(tree, group, np.array(query))
    for node in range(len(tree.low)):
        assert bound[node] >= max(scores[i] for i in tree.ids[tree.low[node] : tree.high[node]])
    best: list = []
    ball_tree.search(tree, group, np.array(query), best)
    assert sorted(best, reverse=True) == sorted(((s, -i) for i, s in enumerate(scores) if s > 0), reverse=True)[:10]


def test_subtrees_are_pruned():
    rng = np.random.default_rng(1)
    documents = [{int(t): int(rng.integers(900, 1000)) for t in rng.choice(20, 12, replace=False) + 20 * (i % 25)} for i in range(2000)]
    group = np.arange(500) // 20
    tree, opened, best = tree_of(documents, group), [], []
    ball_tree.search(tree, group, np.arange(40, 60), best, opened=opened)
    assert sum(opened) < 600 and len(best) == 10


# ---- tries ----------------------------------------------------------------------------------------------------------


def nodes_of(convs):
    """The nodes of {id: [(role, text)]} in plain loops."""
    members = defaultdict(list)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p))
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p], digest))
    return Counter(out)


def made_up(n, seed, kinds=3, depth=6):
    rng = random.Random(seed)
    return {c: [(rng.choice("ab"), "x" * rng.randint(0, kinds)) for _ in range(rng.randint(0, depth))] for c in range(n)}


def table_of(spark, convs, extra=()):
    rows = [(c, t, role, text, "z", 1) for c, own in convs.items() for t, (role, text) in enumerate(own)] + list(extra)
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string, `key.x` int")


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300))
def test_findclose_matches_a_stack(seed, pairs):
    rng = random.Random(seed)
    opens, depth, left = [], 0, pairs
    while left or depth:
        if left and (not depth or rng.random() < 0.6):
            opens.append(True)
            depth, left = depth + 1, left - 1
        else:
            opens.append(False)
            depth -= 1
    stack, close = [], {}
    for i, o in enumerate(opens):
        if o:
            stack.append(i)
        else:
            close[stack.pop()] = i
    at = np.flatnonzero(opens)
    sequence = prefix_trie.Parentheses(np.array(opens))
    ends = sequence.findclose(at)
    assert ends.tolist() == [close[i] for i in at.tolist()]
    pairs_between = [sum(opens[j] and not opens[j + 1] for j in range(i, close[i])) for i in at.tolist()]
    assert sequence.leaves(at, ends).tolist() == pairs_between


@pytest.mark.parametrize(("paths", "turns"), [(8192, 1 << 18), (8, 1 << 18), (20, 25)])
def test_trie_by_brute_force_in_any_number_of_rounds(spark, paths, turns):
    ship(spark)
    convs = {c: own for c, own in made_up(400, 4).items() if own}
    convs |= {c + 1000: [("a", "hot"), ("b", "hot")] for c in range(150)} | {5000: [("a", f"t{i % 7}") for i in range(300)]}
    got = Counter(rows_of(prefix_trie.conversations(table_of(spark, convs), paths, turns)))
    assert got == nodes_of(convs)


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def test_rebuilt_conversations(spark):
    ship(spark)
    convs = {c: own for c, own in made_up(330, 8).items() if own and c != 200}
    convs |= {-1: [("user", "hi")], -105: [("user", "hi"), ("", "")], 10**12 + 7: [("user", "x")] * 9}
    nulls = [(400, None, None, None, "z", 1), (400, 3, "user", "y", "z", 1), (None, 1, "user", "lost", "z", 1)]
    got = Counter(rows_of(prefix_trie.rebuilt(table_of(spark, convs, nulls))))
    assert got == nodes_of(rebuilt(convs | {400: [("", ""), ("user", "y")]}))


def test_tries_of_nothing_ties_and_long_texts(spark):
    ship(spark)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert rows_of(prefix_trie.rebuilt(empty)) == rows_of(prefix_trie.conversations(empty)) == []
    long = "é" * 300_000
    convs = {1: [("user", long)] * 3, 2: [("user", long)] * 2}
    twice = [(1, 0, "user", long, "z", 1)] * 3 + [(2, 0, "user", long, "z", 1)] * 2
    got = Counter(rows_of(prefix_trie.conversations(table_of(spark, {}, twice))))
    assert got == nodes_of(convs)
    tied = [(c, 0, "user", t, "z", 1) for c, order in ((1, "ab"), (2, "ba")) for t in order]
    assert len(rows_of(prefix_trie.conversations(table_of(spark, {}, tied)))) == 3  # equal turns stand alike in both
