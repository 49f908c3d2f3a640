"""Near duplicates, repeated passages, packing, the classifier, the language model and the pipeline against brute force."""

from __future__ import annotations

import itertools
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
from llm_texts import changed, words

import corpus_pipeline
from tidegrid.llm import components, discriminant, hidden_markov, ngram_join, packing, queries, substring_dedup, tokens
from tidegrid.llm import textbatch as tb

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# ---- near duplicates ------------------------------------------------------------------------------------------------


def shingles(text):
    own = WORD.findall(ascii_lower(text or ""))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1)))


def linked_groups(rows):
    """Smallest member per node by union-find over all pairs; nodes are ids, or texts for rows without id."""
    nodes = [(0, r[0], "") if r[0] is not None else (1, 0, r[1] or "") for r in rows]
    sets = [shingles(r[1]) for r in rows]
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(nodes[i]), root(nodes[j])))
                parent[b] = a
    return [(r[0], len(s), root(n)[1] if root(n)[0] == 0 else None) for r, n, s in zip(rows, nodes, sets, strict=True)]


def near_found(frame, **options):
    out = ngram_join.near_duplicates(frame, **options)
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())


def test_near_duplicates_on_awkward_rows(docs, messy):
    assert near_found(docs(messy)) == Counter(linked_groups(messy))


def family(seed: int, size: int, first: int, every: int, length: int = 120):
    """A text and versions of it with other words replaced in each."""
    rng, base = random.Random(seed), words(seed, length).split(" ")
    rows = []
    for k in range(size):
        own = list(base)
        for _ in range(k % every):
            own[rng.randrange(len(own))] = f"v{k}x{rng.randrange(10**6)}"
        rows.append((first + k, " ".join(own)))
    return rows


@pytest.mark.parametrize(("common", "block"), [(2, 4), (3, 50), (16, 1024)])
def test_common_signatures_lose_no_link(docs, common, block):
    """Large groups at and around the threshold, and a passage that unlike documents share: whatever counts as common."""
    rows = family(1, 30, 0, 9) + family(2, 12, 100, 14, 60)
    passage = words(50, 70)
    rows += [(200 + k, f"{words(300 + k, 25)} {passage} {words(400 + k, 10)}") for k in range(25)]
    rows += [(300 + k, f"{words(600 + k // 2, 30)} {passage} {words(700 + k, 3)}") for k in range(12)]
    assert near_found(docs(rows), common=common, block=block) == Counter(linked_groups(rows))


def pages(n: int, shared: int, own: int, first: int = 0, seed: int = 900):
    """Pages of one template: ``shared`` words of it, then words of their own; every tenth has a near copy."""
    template, rows = words(seed, shared), []
    for k in range(n):
        rows.append((first + 2 * k, f"{template} {words(seed + 1 + k, own)}"))
        if k % 10 == 0:
            rows.append((first + 2 * k + 1, f"{rows[-1][1]} copy{k} of{k}"))
    return rows


@pytest.mark.parametrize(("common", "block"), [(2, 4), (4, 16)])
def test_templates_lose_no_link(docs, common, block):
    """Templates below three quarters of a page, between that and six sevenths, and above; sections of one template; bags of stock sentences."""
    rows = pages(60, 84, 36) + pages(40, 110, 25, 1000, 1300) + pages(20, 130, 15, 2000, 1500)
    for section in range(4):
        middle = words(1700 + section, 40)
        rows += [(3000 + 100 * section + k, f"{words(1699, 60)} {middle} {words(1800 + 50 * section + k, 14)}") for k in range(15)]
    rng = random.Random(3)
    stock = [words(2500 + k, 12) for k in range(14)]
    rows += [(4000 + k, " ".join(rng.sample(stock, 9))) for k in range(60)]
    assert near_found(docs(rows), common=common, block=block) == Counter(linked_groups(rows))


@pytest.mark.parametrize("shared", [84, 110])
def test_template_pages_are_not_compared_in_blocks(docs, monkeypatch, shared):
    left = []
    in_blocks = ngram_join._Join.in_blocks

    def counted(self, clusters):
        left.append((clusters.count(), clusters.filter("narrow").count()))
        return in_blocks(self, clusters)

    monkeypatch.setattr(ngram_join._Join, "in_blocks", counted)
    rows = pages(150, shared, 25 if shared > 84 else 36)
    assert near_found(docs(rows), block=32) == Counter(linked_groups(rows))
    assert all(narrow == 0 for _, narrow in left) and (left or shared == 84)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 8, 14, 15, 26, 27, 60, 156, 157, 279, 280, 300, 497, 700, 1500])
def test_similar_sets_share_a_signature_and_pass_the_sketch(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        a = rng.integers(1, 2**64 - 1, n, dtype=np.uint64)
        kept = a[rng.integers(0, n // 4 + 1) :]
        most = len(kept) * 4 // 3 - n
        if most < 0:
            continue
        b = np.concatenate([kept, rng.integers(1, 2**64 - 1, most, dtype=np.uint64)])
        a, b = np.sort(a), np.sort(b)
        sets = ngram_join.Sets(np.concatenate([a, b]), np.array([len(a), len(b)]), np.array([0, len(a), len(a) + len(b)]))
        owner, marks, _ = ngram_join.signatures(sets)
        assert set(marks[owner == 0].tolist()) & set(marks[owner == 1].tolist())
        assert ngram_join.similar(a, b)
        assert ngram_join.sketches_allow(len(a), len(b), ngram_join.parity_sketch(a), ngram_join.parity_sketch(b))


def test_bands_leave_no_similar_pair_more_than_one_band_apart():
    low, high = ngram_join.bands()
    band = np.searchsorted(high, np.arange(1, 20000))
    partner = np.searchsorted(high, ngram_join.most_partner(np.arange(1, 20000)))
    assert (partner - band <= 1).all()
    assert (low[1:] == high[:-1] + 1).all()


def test_node_lists_are_packed_and_unpacked():
    for nodes in ([5], [5, 5, 6], [-3, 0, 2**40, 2**62], list(range(1000))):
        assert ngram_join._unpack_nodes(ngram_join._pack_nodes(np.array(nodes, np.int64))).tolist() == nodes


def test_components_of_chains_stars_and_rings(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(200, 200 + k) for k in range(1, 40)]
    ring = [(300 + k, 300 + (k + 7) % 20) for k in range(20)]
    links = spark.createDataFrame([*chain, *star, *ring, (5, 5), (900, 901), (901, 900)], "a long, b long")
    found = {r.node: r.component for r in components.components(links).collect()}
    expected = {n: 100 for n in range(100, 161)} | {n: 200 for n in range(200, 240)} | {n: 300 for n in range(300, 320)} | {900: 900, 901: 900}
    assert found == expected


# ---- repeated passages ----------------------------------------------------------------------------------------------


def without_repeats(rows, window):
    order = {id(r): (r[0] is None, r[0] or 0) for r in rows}
    first = {}
    for r in rows:
        own = WORD.findall(r[1] or "")
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            first[key] = min(first.get(key, order[id(r)]), order[id(r)])
    out = Counter()
    for r in rows:
        own = WORD.findall(r[1] or "")
        gone = {i + j for i in range(len(own) - window + 1) if first[tuple(own[i : i + window])] < order[id(r)] for j in range(window)}
        out[(r[0], len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone))] += 1
    return out


@pytest.mark.parametrize(("window", "period"), [(50, 31), (12, 7), (5, 1)])
def test_repeats_by_brute_force(docs, messy, window, period):
    passage = words(77, 64)
    rows = messy + [(400 + k, f"{words(500 + k, k)} {passage[k:]} {words(600 + k, 40)} {passage}") for k in range(12)]
    rows = [r for r in rows if len(r[1] or "") < 50_000 or window == 50]
    found = Counter(tuple(r) for r in substring_dedup.remove_repeats(docs(rows), window=window, period=period).collect())
    assert found == without_repeats(rows, window)


@pytest.mark.parametrize("period", range(1, 32))
def test_every_difference_has_a_common_cover_position(period):
    cover = substring_dedup.difference_cover(period)
    assert all(any((i + d) % period in cover and (j + d) % period in cover for d in range(period)) for i in range(period) for j in range(period))


# ---- packing --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def byte_bpe():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())

    def ids(text, literal=False):
        tokenizer.encode_special_tokens = literal
        return tokenizer.encode(text, add_special_tokens=False).ids

    return ids


PIECES = ["<|endoftext|>", "<|endoftext|", "|>", " ", "  ", "\n", "a", "It's", "é9"]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aé' \t\n\x0b\x1c\x1f\x85\xa0 sdI'll<|endoftext>9٣😀", max_size=60) | st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_ids_are_those_of_the_tokenizer(byte_bpe, text):
    for literal in (False, True):
        assert next(iter(tokens.encoder(queries.vocabulary(), literal)([text]))).tolist() == byte_bpe(text, literal)


def test_an_added_token_inside_a_text_is_one_id(byte_bpe):
    found = next(iter(tokens.encoder(queries.vocabulary())(["hello <|endoftext|> world"]))).tolist()
    assert found == byte_bpe("hello <|endoftext|> world") == [31373, 220, 50256, 995]


def check_pieces(pieces, expected, length):
    """``expected``: ids per id of the document, as a multiset of id lists."""
    whole = defaultdict(list)
    for p in pieces:
        assert p.length > 0 and len(p.ids) == 4 * p.length and p.ids_crc32 == zlib.crc32(p.ids)
        whole[p.sequence_id].append(p)
    for own in whole.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or at & (at - 1) == 0
    line = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    documents, current = Counter(), None
    for p in line:
        if p.start == 0:
            current = [p.doc_id, b""]
        assert current[0] == p.doc_id and len(current[1]) == 4 * p.start
        current[1] += p.ids
        if len(current[1]) == 4 * p.doc_tokens:
            documents[tuple(current)] += 1
    assert documents == expected


@pytest.mark.parametrize("length", [64, 2048])
def test_packing_keeps_every_id_once(docs, messy, byte_bpe, length):
    expected = Counter((r[0], np.array([*byte_bpe(r[1] or ""), 1], "<u4").tobytes()) for r in messy)
    check_pieces(packing.pack(docs(messy), queries.vocabulary(), length=length).collect(), expected, length)


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_keys_walk_the_grid(dimensions, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = packing.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_alike_documents_are_neighbours(docs):
    rows = [(k, " ".join(random.Random(k).choices(words(900 + k % 4, 30).split(" "), k=120))) for k in range(120)]
    pieces = packing.pack(docs(rows), queries.vocabulary(), length=2048).collect()
    order = [p.doc_id % 4 for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)) if p.start == 0]
    assert sum(a != b for a, b in itertools.pairwise(order)) < 40  # 90 in random order


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 300), st.integers(1, 300), st.integers(0, 300), st.sampled_from([1, 8, 64]))
def test_cuts_are_gapless(begin, size, more, length):
    total, at = begin + size + more, 0
    for start, n, _, offset in packing.cut(begin, size, total, length):
        assert start == at and n > 0 and offset + n <= length
        at += n
    assert at == size


# ---- classifier -----------------------------------------------------------------------------------------------------


def test_statistics_do_not_depend_on_the_batch(messy):
    texts = [r[1] for r in messy]
    whole = discriminant.statistics(*tb.utf8(pa.array(texts)))
    one = np.concatenate([discriminant.statistics(*tb.utf8(pa.array([t], pa.string()))) for t in texts])
    np.testing.assert_allclose(whole, one, atol=1e-12)
    assert np.isfinite(whole).all()


def junk(seed):
    return " ".join(w + "###" for w in words(seed, 60).upper().split(" "))


def test_model_is_that_of_all_training_rows_and_tells_junk(spark, docs):
    rows = [(k, junk(k) if k % 5 == 1 else words(k, 50 + k % 40)) for k in range(400)] + [(900, None), (901, ""), (None, "a b"), (3, words(3, 53))]
    labels = spark.createDataFrame([(k, int(k % 5 != 1), 0) for k in range(400)] + [(7, None, 0), (None, 1, 0), (12345, 1, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    found = discriminant.classify(docs(rows), labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(held) > 40 and sum(r.predicted == (r.doc_id % 5 != 1) for r in held) >= 0.97 * len(held)

    # brute force: the same moments from numpy, the densities by a general solver
    train = [(r[1], int(r[0] % 5 != 1)) for r in rows if r[0] is not None and r[0] < 400 and zlib.crc32(str(r[0]).encode()) % 5]
    x = discriminant.statistics(*tb.utf8(pa.array([t for t, _ in train])))
    y = np.array([c for _, c in train])
    z = (x - x.mean(0)) / np.sqrt(np.maximum(x.var(0), 1e-12))
    every = discriminant.statistics(*tb.utf8(pa.array([r[1] for r in rows], pa.string())))
    every = (every - x.mean(0)) / np.sqrt(np.maximum(x.var(0), 1e-12))
    within = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum((y == c).mean() * within[c] for c in (0, 1))
    goal = 0.9 * pooled + 0.1 * np.diag(np.diag(pooled))
    logs = []
    for c in (0, 1):
        s = 0.8 * within[c] + 0.2 * goal + 1e-3 * np.eye(len(pooled))
        away = every - z[y == c].mean(0)
        logs.append(math.log((y == c).mean()) - 0.5 * (np.linalg.slogdet(s)[1] + np.einsum("ij,ij->i", away, np.linalg.solve(s, away.T).T)))
    expected = defaultdict(set)
    for r, p in zip(rows, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700))), strict=True):
        expected[r[0]].add(round(float(p), 5))
    assert all(round(r.score, 5) in expected[r.doc_id] for r in found)


def test_scores_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in discriminant.classify(docs([(1, "a"), (2, None)]), none).collect()} == {0.5}


# ---- language model -------------------------------------------------------------------------------------------------


def by_hand(model, sequence, begins=True):
    """Forward-backward of one sequence in plain loops."""
    states = range(len(model.start))
    first = model.start if begins else model.overall
    alpha = [[first[j] * model.emit[sequence[0], j] for j in states]]
    for c in sequence[1:]:
        alpha.append([sum(alpha[-1][i] * model.step[i, j] for i in states) * model.emit[c, j] for j in states])
    beta = [[1.0 for _ in states]]
    for c in reversed(sequence[1:]):
        beta.insert(0, [sum(model.step[i, j] * model.emit[c, j] * beta[0][j] for j in states) for i in states])
    return np.array(alpha), np.array(beta), sum(alpha[-1])


@pytest.fixture(scope="module")
def small_model():
    rng = np.random.default_rng(3)
    emit = rng.random((hidden_markov.CLASSES, 3))
    step = rng.random((3, 3))
    return hidden_markov.Model(np.array([0.5, 0.3, 0.2]), np.array([0.2, 0.2, 0.6]), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def test_counts_and_likelihood_by_hand(small_model):
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 5, n) for n in (1, 7, 3, 7, 2)]
    begins = np.array([True, False, True, True, False])
    counts, likelihood = hidden_markov.expected_counts(small_model, sequences, begins)
    emit, step, start, total = np.zeros_like(counts["emit"]), np.zeros((3, 3)), np.zeros(3), 0.0
    for sequence, begin in zip(sequences, begins, strict=True):
        alpha, beta, whole = by_hand(small_model, sequence, begin)
        total += math.log(whole)
        gamma = alpha * beta / whole
        np.add.at(emit, sequence, gamma)
        start += gamma[0] * begin
        for t in range(1, len(sequence)):
            step += np.outer(alpha[t - 1], small_model.emit[sequence[t]] * beta[t]) * small_model.step / whole
    assert likelihood == pytest.approx(total, rel=1e-4)
    for name, value in (("emit", emit), ("step", step), ("start", start)):
        np.testing.assert_allclose(counts[name], value, rtol=2e-3, atol=1e-5)
    found = hidden_markov.log10_likelihood(small_model, small_model.emit, sequences)
    np.testing.assert_allclose(found, [math.log10(by_hand(small_model, s)[2]) for s in sequences], rtol=1e-9)


@given(st.lists(st.text(alphabet="aZ \t\n\x0b\x1f\u00a0\u00e9", max_size=12), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_are_counted_as_they_are_found(texts):
    data, offsets = tb.utf8(pa.array(texts, pa.string()))
    assert tb.number_of_words(data, offsets) == len(tb.words(data, offsets).hashes) == sum(len(WORD.findall(t)) for t in texts)


def test_counts_do_not_depend_on_which_sequences_stand_side_by_side(small_model):
    rng = np.random.default_rng(6)
    sequences = [rng.integers(0, 9, n) for n in rng.integers(1, 40, 60)]
    begins = rng.random(60) < 0.5
    whole, likelihood = hidden_markov.expected_counts(small_model, sequences, begins)
    parts = [hidden_markov.expected_counts(small_model, sequences[at : at + 7], begins[at : at + 7]) for at in range(0, 60, 7)]
    assert likelihood == pytest.approx(sum(x for _, x in parts), rel=1e-5)
    for name, value in whole.items():
        np.testing.assert_allclose(value, sum(c[name] for c, _ in parts), rtol=1e-4, atol=1e-5)
    one = [hidden_markov.log10_likelihood(small_model, small_model.emit, [s])[0] for s in sequences]
    np.testing.assert_allclose(hidden_markov.log10_likelihood(small_model, small_model.emit, sequences), one, rtol=1e-12)


def test_emissions_of_single_words_add_up(small_model):
    counts = np.random.default_rng(5).integers(0, 4, (hidden_markov.WORD_CLASSES, 3))
    totals = np.append(counts.sum(axis=1), [7, 0]).astype(float)
    model = hidden_markov.normalised({"emit": np.outer(totals, [0.2, 0.3, 0.5]), "step": np.ones((3, 3)), "start": np.ones(3)}, smoothing=1e-3)
    emit = hidden_markov.word_emissions(model, totals, 0.1)
    of_words = (counts[:, :, None] * emit[: hidden_markov.WORD_CLASSES, None, :]).sum(axis=(0, 1))
    np.testing.assert_allclose(of_words + emit[hidden_markov.END] + emit[hidden_markov.UNKNOWN], 1.0, atol=1e-5)


def test_scores_counts_and_base_by_hand(docs, messy):
    rows = messy + [(1000 + k, " ".join(random.Random(k).choices(words(900 + k % 2, 25).split(" "), k=60))) for k in range(150)]
    found = hidden_markov.score(docs(rows), iterations=3).collect()
    held = {r[0]: zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 2 for r in rows}
    own = [(r[0], WORD.findall(ascii_lower(r[1] or "")) + ["\n"]) for r in rows]
    counts = Counter(w for i, t in own if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    expected = Counter(
        (i, held[i], len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)) for i, t in own
    )
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    fresh = [r for r in found if r.held_out and (r.doc_id or 0) >= 1000]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)


def test_likelihood_rises_with_training(docs):
    rows = [(k, " ".join(random.Random(k).choices(words(900 + k % 3, 25).split(" "), k=80))) for k in range(90)]
    corpus = hidden_markov.encoded(docs(rows))
    totals = hidden_markov.class_counts(corpus.rows.filter("NOT held_out"))
    _, path = hidden_markov.train_model(corpus.rows, totals, states=3, iterations=4)
    assert path == sorted(path) and path[-1] > path[0]


def test_words_of_one_class_have_emissions_of_their_own(docs):
    """Two words of one class, equally often, in texts of two kinds: each is likelier among its own kind."""
    text = " ".join(f"n{k}" for k in range(400))
    hashes = tb.words(*tb.utf8(pa.array([text]))).hashes % np.uint64(hidden_markov.FREQUENT_CLASSES)
    seen = {}
    one, other = next((seen[h], k) for k, h in enumerate(hashes) if h in seen or seen.setdefault(h, k) is None)
    kinds = [[*words(900 + k, 12).split(" "), f"n{(one, other)[k]}"] for k in (0, 1)]
    held = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 7 == 2][:4]
    rows = [(1000 + k, " ".join(kinds[k % 2] * 6)) for k in range(80) if zlib.crc32(str(1000 + k).encode()) % 7 != 2]
    of_kind = Counter(t.split(" ")[0] for _, t in rows)
    least = min(of_kind.values())
    rows = [r for first in of_kind for r in [x for x in rows if x[1].startswith(first)][:least]]
    asked = [(held[2 * k + j], " ".join([*kinds[k][:12], kinds[k ^ j][12], *kinds[k][:12]])) for k in (0, 1) for j in (0, 1)]
    score = {r.doc_id: r.score for r in hidden_markov.score(docs(rows + asked)).collect()}
    assert score[held[0]] > score[held[1]] + 0.5 and score[held[2]] > score[held[3]] + 0.5


def test_emissions_of_all_words_add_up(docs):
    rows = [(k, " ".join(random.Random(k).choices(words(900 + k % 3, 25).split(" "), k=80))) for k in range(90)]
    corpus = hidden_markov.encoded(docs(rows))
    totals = hidden_markov.class_counts(corpus.rows.filter("NOT held_out"))
    model, _ = hidden_markov.train_model(corpus.rows, totals, states=3, iterations=2)
    trained, path = hidden_markov.train_words(corpus, model, iterations=3)
    assert len(path) == 3 and path[-1] > path[0]
    known = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in WORD.findall(ascii_lower(t)))
    total = np.zeros(3)
    for tile, part in itertools.groupby(sorted(trained.told.filter("tile >= 0").collect(), key=lambda r: r.tile), key=lambda r: r.tile):
        told = hidden_markov.tt.table([tuple(r) for r in part], hidden_markov._TOLD)
        emit, _ = hidden_markov._own_emissions(told, trained.model, trained.words, trained.end, 0.1)
        keys = np.frombuffer(b"".join(r.keys for r in corpus.asked.filter(f"tile = {tile}").orderBy("bucket").collect()), np.uint64)
        for word in list(known):
            at = np.flatnonzero(keys == tb.words(*tb.utf8(pa.array([word]))).hashes[0])
            if len(at):
                total += known.pop(word) * emit[hidden_markov.OWN_WORDS + at[0]]
    assert not known
    np.testing.assert_allclose(total + emit[hidden_markov.OWN_END] + emit[hidden_markov.OWN_UNKNOWN], 1.0, atol=1e-9)


# ---- empty tables, queries and the pipeline -------------------------------------------------------------------------


def test_empty_tables(spark, docs):
    none = docs([])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for out in (
        ngram_join.near_duplicates(none), ngram_join.representatives(none), substring_dedup.remove_repeats(none), packing.pack(none, queries.vocabulary()),
        discriminant.classify(none, labels), hidden_markov.score(none),
    ):
        assert out.collect() == []


def test_only_unknown_words_without_training_rows(docs):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    row = hidden_markov.score(docs([(held, "some words")])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and math.isfinite(row.score)


def test_pipeline_by_brute_force(spark, docs, tmp_path, byte_bpe):
    """Every stage on its predecessor's rows, against plain Python."""
    passage = words(2, 60)
    rows = [(k, f"{words(k, 55 + k % 30)} {passage if k % 9 == 0 else ''}", "abc"[k % 3], "en") for k in range(80)]
    rows += [(100 + k, rows[k][1].replace(" ", "\n ", 1), "b", "en") for k in range(10)]
    rows += [(200 + k, changed(rows[20 + k][1], 61, "n"), "a", "en") for k in range(10)]
    rows += [(300, "short", "a", "en"), (301, junk(5) * 2, "a", "en"), (302, None, None, None), (303, "a b c " * 60, "c", "en")]
    docs(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "pack"]
    for name, function in corpus_pipeline.STAGES[:-1]:
        frame = function(spark, frame, str(tmp_path))
        assert frame.dtypes == [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
        frame = spark.createDataFrame(frame.collect(), frame.schema)
        if name == "quality":
            assert sorted(r.doc_id for r in frame.collect()) == sorted(r[0] for r in rows if r[0] < 300)
        if name == "exact":
            assert sorted(r.doc_id for r in frame.collect()) == sorted(r[0] for r in rows if r[0] < 100 or 200 <= r[0] < 300)
        if name == "near":
            before = [r for r in rows if r[0] < 100 or 200 <= r[0] < 300]
            kept = [i for i, _, first in linked_groups(before) if i == first]
            assert sorted(r.doc_id for r in frame.collect()) == sorted(kept)
            assert len(kept) < len(before)
    mixed = [(r.doc_id, r.text) for r in frame.collect()]
    expected = Counter((i, np.array([*byte_bpe(t), 1], "<u4").tobytes()) for i, t in mixed)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_pieces(pieces, expected, packing.LENGTH)


def test_queries_have_one_row_per_document(spark):
    sf_dir = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op3_hidden_markov", "op4_quality_classifier", "op10_substring_dedup"):
        out = queries.queries()[name](spark, sf_dir)
        assert out.count() == n and out.select("doc_id").distinct().count() == n
