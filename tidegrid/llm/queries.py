"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import (
    ball_tree,
    chat,
    discriminant,
    exact_dedup,
    hidden_markov,
    mixing,
    ngram_join,
    packing,
    prefix_trie,
    quality_rules,
    substring_dedup,
    subword,
    url_rules,
)
from tidegrid.llm.frames import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return run

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def near_sql(source: str = "documents") -> str:
    """CTEs ending in ``near(doc_id, n_shingles, component_id)``."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH RECURSIVE tw AS (SELECT doc_id, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') AS w FROM {source}),
sh AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM tw WHERE len(w) > 0)),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT a, b FROM common JOIN sz x ON x.doc_id = a JOIN sz y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(a, b) AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b),
near AS (SELECT tw.doc_id, coalesce(any_value(sz.n), 0)::BIGINT AS n_shingles, least(tw.doc_id, coalesce(min(r.b), tw.doc_id)) AS component_id
  FROM tw LEFT JOIN sz ON sz.doc_id = tw.doc_id LEFT JOIN reach r ON r.a = tw.doc_id GROUP BY tw.doc_id)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@register(
    r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n"""
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts: which row of each group stays, and every text's digest."""
    docs = documents(spark, sf_dir)
    digest = docs.select(
        F.col("doc_id").alias("id"),
        F.xxhash64(exact_dedup.normalised(F.col("text"))).alias("h"),
        exact_dedup.text_sha256(F.col("text")).alias("text_sha256"),
    ).distinct()
    return (
        exact_dedup.classify(docs)
        .join(digest, F.expr("doc_id <=> id AND row_hash = h"))
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    )


def _mix_sql(offsets: int = mixing.OFFSETS, seed: str = mixing.SEED, most: int = mixing.MAX_COPIES) -> str:
    copies = "(floor((rank + 1) * rate + u) - floor(rank * rate + u))"
    return rf"""
WITH d AS (SELECT doc_id, source, len({WORDS_SQL})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight FROM s),
r AS (SELECT *, source_size * {most} AS cap, source_size * {most} / weight AS reach FROM w),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER before, 0))::BIGINT / (sum(weight) OVER after)::BIGINT AS level FROM r
  WINDOW before AS (ORDER BY reach, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY reach, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(weight * (SELECT arg_min(level, reach) FROM l WHERE level <= reach), cap::DOUBLE)) AS target FROM l),
p AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END::DOUBLE AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id) - 1 AS rank
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (SELECT source, k, ('0x' || substr(md5('{seed}/' || k || '/' || coalesce('=' || source, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM s, range({offsets}) o(k)),
m AS (SELECT p.source, u.k, any_value(u.u) AS u, abs(sum({copies}::BIGINT * size) - any_value(target)) AS miss
  FROM p JOIN u ON p.source IS NOT DISTINCT FROM u.source GROUP BY p.source, u.k),
c AS (SELECT source, arg_min(u, (miss, k)) AS u FROM m GROUP BY source)
SELECT doc_id, size, source_size, target, ({copies}::BIGINT * size)::BIGINT AS taken
FROM p JOIN c ON p.source IS NOT DISTINCT FROM c.source"""


@register(_mix_sql())
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


@register(
    rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
o AS (SELECT *, row_number() OVER w AS n, lag(role) OVER w AS earlier, lead(role) OVER w AS later FROM c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS t,
    regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g') AS r FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(t) + CASE WHEN earlier IS NULL OR earlier <> role THEN 13 + length(r) ELSE 10 END
    + CASE WHEN later IS NULL OR later <> role THEN 11 ELSE 0 END)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id"""
)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, then read back: turns, text under the loss mask, and sizes."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")),
                F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")),
            )
        ).alias("t"),
    ).select("conv_id", "t.turn", "t.role", F.lit(CONTROL_TEXT).alias("text"))
    done = chat.format_conversations(rows.unionByName(added))
    back = done.select(
        "conv_id",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _rules_sql() -> str:
    tests = [
        (r.host + r.path, r.verdict, f"(host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}')")
        for r in sorted(url_rules.RULES, key=lambda r: (-len(r.host + r.path), r.host + r.path))
    ]
    rule = " ".join(f"WHEN {test} THEN '{name}'" for name, _, test in tests)
    verdict = " ".join(f"WHEN {test} THEN '{said}'" for _, said, test in tests)
    return rf"""
WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['h', 'p']) AS x FROM pages),
v AS (SELECT page_id, translate(x.h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, x.p AS path FROM u)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE 'allow' END AS verdict FROM v"""


@register(_rules_sql())
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict for every page's url."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES))


def quality_sql(source: str = "documents") -> str:
    """CTEs ending in ``judged(doc_id, ..., base_failed, kept)``."""
    rules = quality_rules.RULES
    cells = " UNION ALL ".join(
        f"SELECT lang, source, {k} AS rule, (CASE WHEN {r.whole} > 0 THEN {r.part} * 1000 // {r.whole} ELSE 0 END)::BIGINT AS v FROM m WHERE NOT base_failed"
        for k, r in enumerate(rules)
    )
    settings = ", ".join(f"({k}, {r.spread}::DOUBLE, {r.slack})" for k, r in enumerate(rules))
    value = "(((cell - 32 * greatest(cell // 32 - 1, 0) + 1) << greatest(cell // 32 - 1, 0)::INT) - 1)"

    def fence(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        part = f"PARTITION BY {by}rule"
        return f"""{name}_r AS (SELECT {by}rule, cell, sum(sum(n)) OVER ({part}) AS docs, sum(sum(n)) OVER ({part} ORDER BY cell) AS upto FROM k GROUP BY {by}rule, cell),
{name}_q AS (SELECT {by}rule, max(docs) AS docs, min({value}) FILTER (WHERE upto * 4 >= docs) AS q1, min({value}) FILTER (WHERE upto * 4 >= docs * 3) AS q3 FROM {name}_r GROUP BY {by}rule),
{name} AS (SELECT q.*, q3 + spread * (q3 - q1) + slack AS fence FROM {name}_q q JOIN settings USING (rule))"""

    inside = " AND ".join(
        f"(CASE WHEN {r.whole} > 0 THEN {r.part} * 1000 // {r.whole} ELSE 0 END <= f{k} OR f{k} IS NULL)" for k, r in enumerate(rules)
    )
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {WORDS_SQL} AS w FROM {source}),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c >= 2),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
li AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines FROM d),
m0 AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[ 	-
]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
    length(regexp_replace(t, '[^!?=~^_{{}}\[\]\@+]+', '', 'g'))::BIGINT AS n_stray
  FROM d JOIN li USING (doc_id) LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m0),
v AS ({cells}),
k AS (SELECT lang, source, rule, (v >> greatest(length(bin(v)) - 6, 0)::INT) + 32 * greatest(length(bin(v)) - 6, 0) AS cell, count(*) AS n FROM v GROUP BY ALL),
settings(rule, spread, slack) AS (VALUES {settings}),
{fence("own", "lang, source")},
{fence("lan", "lang")},
{fence("every", "")},
each AS (SELECT o.lang, o.source, o.rule, (o.docs * o.fence + {quality_rules.PRIOR_LANG} * l.fence + {quality_rules.PRIOR_ALL} * a.fence) / (o.docs + {quality_rules.PRIOR_LANG + quality_rules.PRIOR_ALL}) AS fence
  FROM own o JOIN lan l ON o.lang IS NOT DISTINCT FROM l.lang AND o.rule = l.rule JOIN every a ON o.rule = a.rule),
limits AS (SELECT lang, source, {", ".join(f"max(fence) FILTER (WHERE rule = {k}) AS f{k}" for k in range(len(rules)))} FROM each GROUP BY lang, source),
judged AS (SELECT m.*, NOT base_failed AND {inside} AS kept
  FROM m LEFT JOIN limits l ON m.lang IS NOT DISTINCT FROM l.lang AND m.source IS NOT DISTINCT FROM l.source)"""


@register(quality_sql() + " SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality_rules.verdicts(documents(spark, sf_dir)).drop("lang", "source", "n_lines", "n_stray")


def vocabulary() -> str:
    """The public vocabulary of the packing query; installed with the library on every executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of at most 2048 ids."""
    return packing.pack(documents(spark, sf_dir), vocabulary()).drop("ids")


@register(
    rf"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
v AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS low FROM v) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hit),
kept AS (SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) a ANTI JOIN gone g ON a.doc_id = g.doc_id AND a.p = g.p GROUP BY a.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id"""
)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that smaller documents have."""
    done = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register(near_sql() + " SELECT doc_id, n_shingles, component_id FROM near")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of shingles and the smallest document it is linked with, directly or not."""
    return ngram_join.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@register()
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, trained on the labels outside fold 0."""
    return discriminant.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@register()
def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the model, beside that of single words."""
    return hidden_markov.score(documents(spark, sf_dir))


@register()
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return subword.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


TERMS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@register(
    rf"""
WITH t AS (SELECT doc_id, {TERMS_SQL} AS w FROM documents),
l AS (SELECT doc_id, len(w)::BIGINT AS n FROM t WHERE len(w) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM l),
i AS (SELECT DISTINCT item_id, unnest({TERMS_SQL}) AS term FROM benchmark),
f AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS term FROM t) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
d AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM f GROUP BY term), c),
s AS (SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms)))))::BIGINT AS score
  FROM f JOIN d USING (term) JOIN l USING (doc_id) JOIN i USING (term), c GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ball_tree.rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


CRC32_SQL = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: "
    "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295)"
)


@register(
    rf"""
WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {CRC32_SQL.format("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM o)),
b AS (SELECT c.conv_id, 0 AS part, n, role, text FROM c JOIN o ON o.conv_id = c.base AND n <= h
  UNION ALL SELECT c.conv_id, 1, n, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND n > h),
r AS (SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars, md5(array_to_string(array_agg(md5(length(role) || '/' || role || text)) OVER w, '')) AS key
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY part, n)),
p AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS above
  FROM (SELECT * FROM r UNION ALL SELECT conv_id, 0, 0, 'root' FROM c)),
n AS (SELECT key, any_value(above) AS above, any_value(depth) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs FROM p GROUP BY key),
k AS (SELECT above AS key, count(*) AS n_children FROM n GROUP BY above),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key)),
t AS (SELECT p.key, count(*) FILTER (WHERE x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.chars)::BIGINT AS saved_tokens
  FROM x JOIN p ON p.conv_id = x.conv_id AND p.depth <= x.depth GROUP BY p.key),
e AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM (SELECT conv_id, arg_max(key, depth) AS key FROM p GROUP BY conv_id) GROUP BY key)
SELECT x.conv_id, x.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, x.n_convs::BIGINT AS n_convs, x.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM x JOIN t ON t.key = x.key LEFT JOIN x u ON u.key = x.above LEFT JOIN e ON e.key = x.key"""
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie.rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
