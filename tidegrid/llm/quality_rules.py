"""Quality rules with adaptive thresholds.

Each text gets a few whole-number measures.  Per (language, source) the distribution of each measure is kept as a quantile sketch:
a log-linear histogram (64 exact cells, then 32 cells per power of two, so a cell is at most 1/32 of its value wide).  Sketches
merge by adding cell counts, so they are one hash aggregation with map-side combine, exact in any order, and the sketch of a language is the sum of
those of its sources.  A far-out fence, ``q3 + spread * (q3 - q1) + slack``, is read from the sketch of the group, of its
language and of all; the threshold is their mean, weighted by the group's number of texts, ``PRIOR_LANG`` and ``PRIOR_ALL``.  So a
large group follows its own texts, a small one mostly its language, and one text more moves a threshold a little at every size.  Rows
are then joined with the thresholds of their group and filtered.

Fences replace fixed cutoffs: they follow what is normal for a group and reject no fixed share of it; ``slack`` keeps a group whose
texts are all alike from rejecting the first one that differs a little.

Defined cases: a null text has no words (and fails the base rule); null languages and sources are groups of their own;
an empty table gives an empty table; repeated rows count and are judged alike; other columns, whatever their names, pass
through ``keep`` untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm import textbatch as tb
from tidegrid.llm.frames import checked_broadcast, col, fresh
from tidegrid.session import stage

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stray")
MIN_WORDS = 50
PRIOR_LANG, PRIOR_ALL = 100, 10
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_STRAY = np.zeros(256, dtype=bool)
_STRAY[[ord(c) for c in "!?=~^_{}[]\\@+"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True


class Rule(NamedTuple):
    """A measure in parts per 1000 of another; rejected above the group's fence."""

    name: str
    part: str
    whole: str
    spread: float
    slack: int


RULES = (
    Rule("symbols", "n_symbols", "n_words", 6.0, 150),
    Rule("stray", "n_stray", "n_words", 6.0, 300),
    Rule("dup_lines", "n_dup_lines", "n_lines", 6.0, 400),
    Rule("repeats", "n_repeat_words", "n_words", 6.0, 450),
    Rule("word_length", "word_chars", "n_words", 6.0, 4000),
)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(w: tb.Words) -> np.ndarray:
    """Words of each text covered by a 3-word window that the text has at least twice."""
    at = tb.run_starts(w.first, 3)
    covered = np.zeros(len(w.hashes) + 2, bool)
    if len(at):
        text = w.text_of()[at]
        key = tb.runs(w.hashes, 3)[at] ^ tb.mix(text.astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = at[np.union1d(order[1:][same], order[:-1][same])]
        for j in range(3):
            covered[twice + j] = True
    return _per_text(covered[: len(w.hashes)], w.first)


def _repeated_lines(text: str) -> tuple[int, int]:
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def measure_column(column) -> dict[str, np.ndarray]:
    """All measures of the texts of an Arrow string column."""
    out: dict[str, list] = {name: [] for name in MEASURES}
    for row, to, data, offsets in tb.chunks(column):
        w = tb.words(data, offsets)
        out["n_words"].append(w.counts())
        begins_char = ((data & 0xC0) != 0x80) & ~tb._SPACE[data]
        out["word_chars"].append(_per_text(begins_char, offsets))
        out["n_symbols"].append(_per_text(_SYMBOL[data], offsets))
        out["n_stray"].append(_per_text(_STRAY[data], offsets))
        out["n_repeat_words"].append(_repeated_words(w))
        lines = np.array([_repeated_lines(t or "") for t in column.slice(row, to - row).to_pylist()], np.int64).reshape(-1, 2)
        out["n_lines"].append(lines[:, 0])
        out["n_dup_lines"].append(lines[:, 1])
    return {k: np.concatenate(v).astype(np.int64) if v else np.empty(0, np.int64) for k, v in out.items()}


def measured(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with one long column per measure; the names chosen for them (free of clashes) by measure."""
    names = dict(zip(MEASURES, fresh(docs, *MEASURES), strict=True))
    place = docs.columns.index(text_col)
    labels = [*docs.columns, *names.values()]

    def add(batches):
        for batch in batches:
            figures = measure_column(batch.column(place))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(figures[m], pa.int64()) for m in MEASURES)], names=labels)

    schema = ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in [*docs.dtypes, *((n, "long") for n in names.values())])
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # mapInArrow cannot take names with dots
    return plain.mapInArrow(add, schema), names


def base_failed(names: dict[str, str], min_words: int = MIN_WORDS) -> Column:
    n, repeated = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (n < min_words) | (100 * repeated > 50 * n)


def ratio(rule: Rule, names: dict[str, str]) -> Column:
    """Parts per 1000, as a whole number; 0 where there is nothing to divide by."""
    part, whole = F.col(names[rule.part]), F.col(names[rule.whole])
    return F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(F.lit(0)).cast("long")


def cell(value: Column) -> Column:
    """The sketch cell of a whole number: 0..63 as they are, then 32 per power of two."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftright", value, shift).cast("long") + shift.cast("long") * 32


def cell_value(c: Column) -> Column:
    """The largest value of a cell."""
    shift = F.greatest(F.floor(c / 32) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", c - shift.cast("long") * 32 + 1, shift) - 1


def sketches(figures: DataFrame, names: dict[str, str], lang: Column, source: Column, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``lang, source, rule, cell, n``: the mergeable sketches of all groups, from rows that pass the base rule."""
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), cell(ratio(r, names)).alias("cell")) for k, r in enumerate(rules)]))
    rows = figures.filter(~base_failed(names)).select(lang.alias("lang"), source.alias("source"), cells.alias("c"))
    return rows.groupBy("lang", "source", "c.rule", "c.cell").agg(F.count(F.lit(1)).alias("n"))


def fences(cells: DataFrame, keys: Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """Merge sketches up to ``keys`` and read ``docs`` (how many texts) and ``fence`` per rule."""
    merged = cells.groupBy(*keys, "rule", "cell").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    ranked = merged.withColumn("docs", F.sum("n").over(group)).withColumn("upto", F.sum("n").over(group.orderBy("cell")))

    def quantile(q: int) -> Column:
        return F.min(F.when(F.col("upto") * 4 >= F.col("docs") * q, cell_value(F.col("cell"))))

    quartiles = ranked.groupBy(*keys, "rule").agg(F.max("docs").alias("docs"), quantile(1).alias("q1"), quantile(3).alias("q3"))
    settings = F.array(*[F.struct(F.lit(r.spread).alias("spread"), F.lit(r.slack).alias("slack")) for r in rules])
    own = F.get(settings, F.col("rule"))
    return quartiles.select(*keys, "rule", "docs", (F.col("q3") + own["spread"] * (F.col("q3") - F.col("q1")) + own["slack"]).alias("fence"))


def thresholds(cells: DataFrame, rules: Sequence[Rule] = RULES, prior: tuple[int, int] = (PRIOR_LANG, PRIOR_ALL)) -> DataFrame:
    """``lang, source, limits`` (an array in the order of ``rules``) for every group."""
    own = fences(cells, ["lang", "source"], rules).alias("o")
    by_lang = fences(cells, ["lang"], rules).alias("l")
    overall = fences(cells, [], rules).alias("a")
    joined = own.join(by_lang, F.expr("o.lang <=> l.lang AND o.rule = l.rule")).join(overall, F.expr("o.rule = a.rule"))
    fence = F.expr(f"(o.docs * o.fence + {prior[0]} * l.fence + {prior[1]} * a.fence) / (o.docs + {sum(prior)})")
    each = joined.select("o.lang", "o.source", "o.rule", fence.alias("fence"))
    by_rule = [F.max(F.when(F.col("rule") == k, F.col("fence"))) for k in range(len(rules))]
    return each.groupBy("lang", "source").agg(F.array(*by_rule).alias("limits"))


def judged(figures: DataFrame, names: dict[str, str], limits: DataFrame, lang: Column, source: Column, kept: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``figures`` with a boolean column ``kept``.  A group without a sketch has only texts that fail the base rule."""
    the_lang, the_source, the_limits = fresh(figures, "_lang", "_source", "_limits")
    right = checked_broadcast(limits).select(F.col("lang").alias(the_lang), F.col("source").alias(the_source), F.col("limits").alias(the_limits))
    joined = figures.join(right, lang.eqNullSafe(F.col(the_lang)) & source.eqNullSafe(F.col(the_source)), "left")
    inside = F.lit(True)
    for k, rule in enumerate(rules):
        inside = inside & (ratio(rule, names) <= F.get(F.col(the_limits), F.lit(k)))
    verdict = ~base_failed(names) & F.coalesce(inside, F.lit(True))
    return joined.withColumn(kept, verdict).drop(the_lang, the_source, the_limits)


def keep(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", prior: tuple[int, int] = (PRIOR_LANG, PRIOR_ALL)) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns.  Texts are measured twice rather than moved."""
    light = docs.select(col(text_col).alias("text"), col(lang_col).alias("lang"), col(source_col).alias("source"))
    lit, lit_names = measured(light)
    cells = stage(sketches(lit, lit_names, F.col("lang"), F.col("source")), "rules-cells")
    limits = stage(thresholds(cells, prior=prior), "rules-limits")
    full, names = measured(docs, text_col)
    (kept,) = fresh(full, "_kept")
    return judged(full, names, limits, col(lang_col), col(source_col), kept).filter(F.col(kept)).select(*[col(c) for c in docs.columns])


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", prior: tuple[int, int] = (PRIOR_LANG, PRIOR_ALL)) -> DataFrame:
    """One row per document: id, measures, ``base_failed`` and ``kept``; texts are measured once and not kept."""
    light = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"), col(lang_col).alias("lang"), col(source_col).alias("source"))
    figures, names = measured(light)
    figures = stage(figures.drop("text"), "rules-figures")
    cells = stage(sketches(figures, names, F.col("lang"), F.col("source")), "rules-cells")
    limits = stage(thresholds(cells, prior=prior), "rules-limits")
    out = judged(figures, names, limits, F.col("lang"), F.col("source"), "kept")
    return out.withColumn("base_failed", base_failed(names)).select("doc_id", "lang", "source", *MEASURES, "base_failed", "kept")
