from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(text: Column, terms: Sequence[str], ignore_case: bool = True) -> Column:
    """True when any of the literal terms occurs in the text."""
    subject = F.lower(text) if ignore_case else text
    wanted = [t.lower() if ignore_case else t for t in terms]
    return reduce(or_, (subject.contains(t) for t in wanted))


def first_label(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Label of the first rule with a term in the text (case-insensitive), else the default."""
    chain = F
    for label, terms in rules:
        chain = chain.when(contains_any(text, terms), F.lit(label))
    return chain.otherwise(F.lit(default))


def threshold_label(value: Column, bounds: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first bound the value lies strictly below; NULL and everything else gets ``above``."""
    chain = F
    for limit, label in bounds:
        chain = chain.when(value < F.lit(limit), F.lit(label))
    return chain.otherwise(F.lit(above))


def is_whole_number(text: Column) -> Column:
    return text.rlike("^[0-9]+$")
