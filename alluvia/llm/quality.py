"""Quality rules as a bitmask ledger.

A text is measured once. Every rule looks at the measurements once and owns one bit: the ledger keeps the measurements and the
set of failed bits. A policy is a versioned mask of bits that reject, so policies can be changed, compared and ablated from the
ledger alone, by bitwise operations and sums, without reading a text again.

Null and empty texts measure zero everywhere, so they fail ``few_words``. Rows are kept as they come: repeated rows give
repeated ledger rows, an empty table an empty ledger, and a column named like the ledger's gets out of its way.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.llm.words import SMALL_CHUNK_BYTES, Words, free_name, map_texts, mixed, span_hashes
from alluvia.queries.registry import table

#: Words of the windows that count as repeated when a text has them twice.
WINDOW = 8

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_shouts",
    "n_stutters",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; ``bit`` is the rule's place in the ledger and is never given to another rule."""

    bit: int
    name: str
    fails: str


# Bits and thresholds of the rules. The first two are the base rules.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 2 * n_words"),
    Rule(3, "upper_case", "2 * n_upper > n_upper + n_lower"),
    Rule(4, "shouting", "10 * n_shouts > 3 * n_words"),
    Rule(5, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(6, "stutter", "10 * n_stutters > 3 * n_words"),
    Rule(7, "long_words", "word_chars > 25 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """The rules that reject, under a version that is written beside each verdict."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[name] for name in self.rules)


BASE_POLICY = Policy("base-1", ("few_words", "repeated_windows"))
POLICY = Policy("prose-1", tuple(r.name for r in RULES))

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def measure(texts: list[str | None]) -> list[np.ndarray]:
    """The arrays of ``MEASURES`` for some texts."""
    w = Words(texts)
    data, hashes = w.data, span_hashes(w.data, w.starts, w.ends)
    word_chars = w.per_text(~w.gap & ((data & 0xC0) != 0x80))

    breaks = np.flatnonzero(data == 10)  # every text ends in one that joined it to the next
    line_starts = np.concatenate([[0], breaks[:-1] + 1])
    has_word = np.searchsorted(w.starts, breaks) > np.searchsorted(w.starts, line_starts)
    line_starts, line_ends = line_starts[has_word], breaks[has_word]
    line_text = np.searchsorted(w.text_starts, line_starts, "right") - 1
    n_lines = np.bincount(line_text, minlength=w.n_texts)
    own = mixed(span_hashes(data, line_starts, line_ends) + line_text.astype(np.uint64))
    distinct = line_text[np.unique(own, return_index=True)[1]]
    n_dup_lines = n_lines - np.bincount(distinct, minlength=w.n_texts)

    first, text, window = w.windows(hashes, WINDOW)
    window = mixed(window + text.astype(np.uint64))
    order = np.argsort(window)
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(len(window), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    cover = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(cover, first[twice], 1)
    np.add.at(cover, first[twice] + WINDOW, -1)
    repeated = np.cumsum(cover)[:-1] > 0

    stutter = np.zeros(len(hashes), bool)
    stutter[1:] = hashes[1:] == hashes[:-1]
    stutter[w.first[w.counts > 0]] = False
    return [
        w.counts, word_chars, w.per_text(_SYMBOL[data]), n_lines, n_dup_lines, w.per_word(repeated),
        w.per_text((data >= 65) & (data <= 90)), w.per_text((data >= 97) & (data <= 122)), w.per_text(data == 33),
        w.per_word(stutter),
    ]


def ledger(docs: DataFrame, text: str = "text", keep: list[str] | None = None, into: str = "ledger",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns ``keep`` (all by default) and a struct ``into``: the measurements and ``fail_bits``."""
    fields = [T.StructField(m, T.LongType()) for m in MEASURES]
    hidden = free_name(docs, "_measured")
    measured = map_texts(docs, text, measure, fields, hidden, keep, SMALL_CHUNK_BYTES)
    return measured.withColumn(into, F.struct(f"{hidden}.*", fail_bits(rules, hidden).alias("fail_bits"))).drop(hidden)


def fail_bits(rules: tuple[Rule, ...], struct: str) -> Column:
    """One bit for each rule that the measurements in ``struct`` fail."""
    bits = F.lit(0).cast("long")
    for r in rules:
        fails = re.sub(rf"\b({'|'.join(MEASURES)})\b", rf"{struct}.\1", r.fails)
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def passes(bits: Column, policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether no rule of the policy failed."""
    return bits.bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def ablations(rows: DataFrame, policy: Policy, bits: str = "ledger.fail_bits", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: rows it fails, rows only it rejects (what leaving it out would bring back).

    One aggregation over the ledger with a counter per bit; the result has as many rows as the policy has rules.
    """
    wanted = [r for r in rules if r.name in policy.rules]
    mask, value = F.lit(policy.mask(rules)).cast("long"), F.col(bits)
    one = lambda r: F.lit(1 << r.bit).cast("long")
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.bitwiseAND(mask) != 0).alias("rejected"),
        *(F.count_if(value.bitwiseAND(one(r)) != 0).alias(f"fails_{r.bit}") for r in wanted),
        *(F.count_if(value.bitwiseAND(mask) == one(r)).alias(f"only_{r.bit}") for r in wanted),
    )
    return counts.select("rows", "rejected", F.inline(F.array(*(
        F.struct(F.lit(policy.version).alias("policy"), F.lit(r.name).alias("rule"), F.col(f"fails_{r.bit}").alias("fails"),
                 F.col(f"only_{r.bit}").alias("only")) for r in wanted))))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents"), keep=["doc_id"])
    bits = F.col("ledger.fail_bits")
    return rows.select(
        "doc_id", *(F.col(f"ledger.{m}") for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        (~passes(bits, BASE_POLICY)).alias("base_failed"), passes(bits, POLICY).alias("kept"), bits.alias("fail_bits"),
    )


OP1_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
wins AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
keyed AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS k FROM wins),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM keyed),
reps AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice WHERE c > 1) GROUP BY r),
ls AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
          FROM ls WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
             coalesce(n_dup, 0) AS n_dup_lines, coalesce(reps.n, 0) AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
             length(regexp_replace(t, '[^!]', '', 'g')) AS n_shouts,
             len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutters
      FROM w LEFT JOIN reps USING (r) LEFT JOIN lines USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN 10 * n_symbols > 2 * n_words THEN 4 ELSE 0 END)
             + (CASE WHEN 2 * n_upper > n_upper + n_lower THEN 8 ELSE 0 END)
             + (CASE WHEN 10 * n_shouts > 3 * n_words THEN 16 ELSE 0 END)
             + (CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END)
             + (CASE WHEN 10 * n_stutters > 3 * n_words THEN 64 ELSE 0 END)
             + (CASE WHEN word_chars > 25 * n_words THEN 128 ELSE 0 END) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits FROM b
"""
