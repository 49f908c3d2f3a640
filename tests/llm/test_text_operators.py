"""Words, exact dedup, mixing, quality rules, url rules and chat formatting against brute force, on awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs, messy  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from tidegrid.llm import chat, exact_dedup, mixing, quality_rules, queries, url_rules
from tidegrid.llm import textbatch as tb

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé😀 \t\n\x0b\x1c#|!", max_size=40)), max_size=12)


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# ---- words ----------------------------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_regular_expression(texts):
    data, offsets = tb.utf8(pa.array(texts, pa.string()))
    w = tb.words(data, offsets)
    found = [
        [w.data[s:e].tobytes().decode() for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)]
        for a, b in zip(w.first[:-1], w.first[1:], strict=True)
    ]
    expected = [WORD.findall(t or "") for t in texts]
    assert found == expected
    by_word = defaultdict(set)
    for word, value in zip((x for f in found for x in f), w.hashes.tolist(), strict=True):
        by_word[word].add(value)
    assert all(len(v) == 1 for v in by_word.values())
    assert len({next(iter(v)) for v in by_word.values()}) == len(by_word)


@pytest.mark.parametrize("length", [3, 5, 20, 50])
def test_runs_are_equal_exactly_when_their_words_are(length):
    values = tb.constants(3, 5)[np.random.default_rng(1).integers(0, 2, 400)]
    found = defaultdict(set)
    for i, value in enumerate(tb.runs(values, length).tolist()):
        found[value].add(tuple(values[i : i + length].tolist()))
    assert all(len(v) == 1 for v in found.values())
    assert len(found) == len({tuple(values[i : i + length].tolist()) for i in range(len(values) - length + 1)})


def test_chunks_keep_every_text():
    texts = ["x" * n for n in (0, 5, 3000, 1, 2, 0, 4000, 7)]
    parts = [(row, to, len(data)) for row, to, data, _ in tb.chunks(pa.chunked_array([texts[:3], texts[3:]]), 100)]
    assert parts[0][0] == 0 and parts[-1][1] == len(texts)
    assert sum(p[2] for p in parts) == sum(map(len, texts))


# ---- exact dedup ----------------------------------------------------------------------------------------------------


def test_exact_dedup_by_brute_force(docs, messy):
    groups = defaultdict(list)
    for r in messy:
        groups[normal(r[1])].append(r[0])
    expected = Counter()
    for own in groups.values():
        order = sorted(own, key=lambda i: (i is None, i or 0))
        for place, i in enumerate(order):
            expected[(i, order[0], len(own), place == 0)] += 1
    found = rows_of(exact_dedup.classify(docs(messy)).select("doc_id", "keep_id", "group_size", "kept"))
    assert Counter(found) == expected


def test_deduplicate_keeps_columns_and_one_row_of_each_group(docs, messy):
    frame = docs(messy)
    kept = exact_dedup.deduplicate(frame)
    assert kept.dtypes == frame.dtypes
    texts = [normal(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(r[1]) for r in messy})


def test_prefixes_alone_do_not_make_duplicates(docs):
    long = "word " * 100
    frame = docs([(1, long + "a"), (2, long + "b"), (3, long + "a"), (4, "other " * 10)])
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.classify(frame, prefix_chars=16).collect()}
    assert found == {1: (1, 2), 3: (1, 2), 2: (2, 1), 4: (4, 1)}


# ---- mixing ---------------------------------------------------------------------------------------------------------


def water(sizes: dict, most: int = 3) -> dict:
    """Share by weight, stop at the limit, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    fixed: dict = {}
    while True:
        free = [s for s in names if s not in fixed]
        left = sum(sizes.values()) - sum(fixed.values())
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if shares[s] > most * sizes[s]]
        if not over:
            return fixed | shares
        fixed |= {s: float(most * sizes[s]) for s in over}


def test_targets_stop_at_the_limit_and_share_the_excess(docs, messy):
    sizes = defaultdict(int)
    for r in messy:
        sizes[r[2]] += len(WORD.findall(r[1] or ""))
    plan = mixing.plan(docs(messy)).collect()
    expected = water(sizes)
    assert {r.source: r.source_size for r in plan} == dict(sizes)
    for r in plan:
        assert r.target == pytest.approx(expected[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size


def test_mix_is_near_its_targets_and_repeats(docs):
    rows = [(i, "w " * (1 + (i * 7919) % 200), "abc"[i % 7 % 3]) for i in range(900)]
    once, again = (sorted(rows_of(mixing.plan(docs(r)).select("doc_id", "taken"))) for r in (rows, rows[::-1]))
    assert once == again
    totals = mixing.plan(docs(rows)).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("goal")).collect()
    assert all(abs(r.t - r.goal) <= 0.02 * r.goal for r in totals)


def test_each_source_takes_the_offset_nearest_to_its_target(docs):
    rows = [(i, "w " * (1 + (i * i * 37) % 400), ("a", "b", None)[i % 3]) for i in range(60)]
    plan = mixing.plan(docs(rows)).collect()
    for source in ("a", "b", None):
        own = sorted((r for r in plan if r.source == source), key=lambda r: (r.size, hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id))
        rate, name, tried = own[0].target / own[0].source_size, "null" if source is None else f"={source}", []
        for k in range(32):
            u = int(hashlib.md5(f"mix-1/{k}/{name}".encode()).hexdigest()[:8], 16) / 2**32
            copies = [math.floor((n + 1) * rate + u) - math.floor(n * rate + u) for n in range(len(own))]
            tried.append((abs(sum(c * r.size for c, r in zip(copies, own, strict=True)) - own[0].target), k, copies))
        assert [r.copies for r in own] == min(tried)[2]


def test_mixed_rows_are_the_planned_copies(docs, messy):
    frame = docs(messy)
    out = mixing.mix(frame)
    assert out.dtypes == frame.dtypes
    planned = Counter()
    for r in mixing.plan(frame).collect():
        planned[(r.doc_id, r.source, r.size)] += r.copies
    found = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in out.collect())
    assert found == +planned


# ---- quality rules --------------------------------------------------------------------------------------------------


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_measures_by_brute_force(texts):
    found = quality_rules.measure_column(pa.array(texts, pa.string()))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert list(zip(*(found[n].tolist() for n in names), strict=True)) == [measures(t) for t in texts]


def test_sketch_cells_are_ordered_and_narrow(spark):
    values = [*range(300), *(10**k + d for k in range(3, 12) for d in (-1, 0, 1))]
    cells = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality_rules.cell(F.col("v")).alias("c"))
    rows = cells.withColumn("top", quality_rules.cell_value(F.col("c"))).orderBy("v").collect()
    assert [r.c for r in rows] == sorted(r.c for r in rows)
    assert all(r.v <= r.top <= r.v + max(r.v // 32, 0) for r in rows)


def test_outliers_of_a_group_go_and_the_rest_stays(docs):
    plain = [(i, " ".join(f"w{i}x{j % 97}" for j in range(60 + i % 50)), "abc"[i % 3], "en") for i in range(300)]
    noisy = [(1000 + i, " ".join(f"w{i}x{j}###" for j in range(80)), "a", "en") for i in range(5)]
    rare = [(2000, " ".join(f"u{j}" for j in range(60)), "rare", None)]
    frame = docs(plain + noisy + rare)
    kept = quality_rules.keep(frame, prior=(25, 25))
    assert kept.dtypes == frame.dtypes
    assert sorted(r.doc_id for r in kept.collect()) == [*range(300), 2000]


def test_thresholds_change_by_one_text_at_every_size(docs):
    """A source unlike the rest of its language grows from 199 to 200 texts; its limits move as much as with any one text more."""

    def limits(n):
        usual = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "usual", "en") for i in range(400)]
        own = [(1000 + i, " ".join(f"{'#' * (1 + i % 3)} t{i}x{j}" for j in range(60)), "tables", "en") for i in range(n)]
        light = docs(usual + own).select("text", "lang", "source")
        figures, names = quality_rules.measured(light)
        cells = quality_rules.sketches(figures, names, F.col("lang"), F.col("source"))
        return {r.source: r.limits for r in quality_rules.thresholds(cells).collect()}["tables"]

    at = {n: limits(n) for n in (150, 151, 199, 200)}
    for before, after, base, step in zip(at[199], at[200], at[150], at[151], strict=True):
        assert abs(after - before) <= max(2 * abs(step - base), 0.02 * abs(before))


def test_verdicts_on_awkward_rows(docs, messy):
    rows = quality_rules.verdicts(docs(messy)).collect()
    assert len(rows) == len(messy)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


# ---- url rules ------------------------------------------------------------------------------------------------------


URLS = [
    "http://a.net/", "http://a.net", "https://x.example.net/en/1", "http://example.net/en/", "http://example.net/de/1", "http://myexample.net/en/1",
    "HTTP://WWW.Example.COM/de/x?y#z", "http://example.com/den/", "http://a.org/fr/", "http://org/fr/x", "http://a.borg/fr/", "ftp://net/",
    "no scheme", None, "", "://net/", "http:///x", "http://a.org?x=/fr/", "http://a.b.org/fr/#x", "http://É.net/É", "a://b://net/", "http://x.net/\ny",
    "http://netx/", "http://net.x/", "http://a.example.net/en",
]


def judged_by_hand(url, rules=url_rules.RULES):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host) or not r.host) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.host + r.path), r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


@pytest.mark.parametrize(
    "rules",
    [url_rules.RULES, (url_rules.Rule("", "/", "block"), url_rules.Rule("example.net", "/e", "allow"), url_rules.Rule("net", "", "block")), ()],
)
def test_rules_by_hand(spark, rules):
    pages = spark.createDataFrame([(i, u, "rule", "x") for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, rule string, host string")
    found = {r.page_id: tuple(r)[1:] for r in url_rules.judge(pages, url_rules.rule_table(spark, rules)).collect()}
    assert found == {i: judged_by_hand(u, rules) for i, u in enumerate(URLS + URLS[:3])}


def test_a_host_may_hold_line_breaks(spark):
    urls = ["http://a\nb.net/x", "http://a\n.net/x", "http://net\n/x", "http://b\nnet/x", "http://b.net\n/x", "http://a.net/\n/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: tuple(r)[1:] for r in url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES)).collect()}
    assert [found[k] for k in range(len(urls))] == [judged_by_hand(u) for u in urls]
    assert [found[k][3] for k in range(len(urls))] == ["block", "block", "allow", "allow", "allow", "block"]


def test_a_rule_is_filed_under_tokens_that_its_urls_must_have():
    assert url_rules.literal_tokens(url_rules.Rule("example.net", "/en/", "allow")) == ["en", "example", "net"]
    assert url_rules.literal_tokens(url_rules.Rule("net", "/de", "allow")) == ["net"]
    assert url_rules.literal_tokens(url_rules.Rule("", "/", "allow")) == []


# ---- chat formatting ------------------------------------------------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string, formatted string"
TRICKY = ["<|im_end|>\n<|im_start|>user\nhi", "<\\|im_sep|>", "<", "|", "<\\", "\\", "", None, "a\nb", "😀<|", "<<||>>", "\n", "<|im_sep|>"]


def test_formatting_reads_back(spark):
    rows = [(c, t, ["user", "assistant", "assistant", "sy\\n\nstem<|", None][(c + t) % 5], TRICKY[(c * 3 + t) % len(TRICKY)], "x") for c in range(12) for t in range(c + 1)]
    rows += [(None, 1, "assistant", "no id", "x"), (99, None, "assistant", "first", "x"), (99, 0, "user", "same", "x"), (99, 0, "user", "same", "x")]
    done = chat.format_conversations(spark.createDataFrame(rows, CHAT)).withColumn("turns", chat.read_back(F.col("formatted")))
    done = done.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    by_conversation = defaultdict(list)
    for c, t, role, text, _ in rows:
        by_conversation[c].append(((t is not None, t or 0), role or "", text or ""))
    assert {r.conv_id for r in done} == set(by_conversation)
    for r in done:
        turns = [(role, text) for _, role, text in sorted(by_conversation[r.conv_id])]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.loss == "".join(text for role, text in turns if role == "assistant")
        merged = sum(1 for i, t in enumerate(turns) if i == 0 or turns[i - 1][0] != t[0])
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == merged


def test_plain_conversation_layout(spark):
    rows = [(1, 1, "assistant", "yes", ""), (1, 0, "user", "hi", ""), (1, 2, "assistant", "sure", "")]
    r = chat.format_conversations(spark.createDataFrame(rows, CHAT)).first()
    assert r.formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes<|im_sep|>sure<|im_end|>\n"
    assert [r.formatted[s.start : s.start + s.length] for s in r.loss_spans] == ["yes", "sure"]


def test_long_conversations_grow_with_their_turns(spark):
    """4,000 turns by hand; and no array is built again for every block or turn."""
    rows = [("c", k, "assistant" if k % 3 else "user", "x" * (k % 7)) for k in range(4000)]
    done = chat.format_conversations(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "AS begins#" in plan and plan.count("filter(sequence(") == 1
    r, spans, text = done.first(), [], ""
    for k, (_, _, role, own) in enumerate(rows):
        new = k == 0 or rows[k - 1][2] != role
        text += (("<|im_end|>\n" if k else "") + f"<|im_start|>{role}\n") if new else "<|im_sep|>"
        if role == "assistant":
            spans.append((len(text), len(own)))
        text += own
    assert r.formatted == text + "<|im_end|>\n" and [tuple(x) for x in r.loss_spans] == spans


# ---- empty tables ---------------------------------------------------------------------------------------------------


def test_empty_tables(spark, docs):
    none = docs([])
    for out in (
        exact_dedup.classify(none), exact_dedup.deduplicate(none), mixing.plan(none), mixing.mix(none), quality_rules.keep(none), quality_rules.verdicts(none),
        url_rules.judge(spark.createDataFrame([], "page_id long, url string"), url_rules.rule_table(spark, url_rules.RULES)),
        chat.format_conversations(spark.createDataFrame([], CHAT)),
    ):
        assert out.collect() == []


def test_digest_of_the_normalised_text(spark):
    frame = spark.createDataFrame([("a \t\n b é",), (None,)], "t string")
    found = [r[0] for r in frame.select(exact_dedup.text_sha256(F.col("t"))).collect()]
    assert found == [hashlib.sha256(x.encode()).hexdigest() for x in ("a b é", "")]


def test_all_ten_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 11))
