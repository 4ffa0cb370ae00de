from __future__ import annotations

import pytest

from alluvia.llm.workers import reachable
from tests.conftest import SMALL


@pytest.fixture(scope="session")
def llm(spark):
    return reachable(spark)


@pytest.fixture(scope="session")
def small():
    return SMALL


DOCS = "doc_id bigint, text string, lang string, source string, n_words string, `license` int, node int"


@pytest.fixture(scope="session")
def odd(llm):
    """Null, empty and very long texts, repeated rows, null ids, and columns named like the operators' own."""
    prose = "In the beginning the small river ran by the old mill and all the children of the town went there to swim in summer"
    rows = [
        (1, None, "en", "a", "x", 1, 1), (2, "", None, None, None, None, None), (3, " \t\n ", "en", "", "x", 1, 1),
        (None, prose, "en", "a", "x", 1, 1), (5, prose, "en", "a", "x", 1, 1), (5, prose, "en", "a", "x", 1, 1),
        (6, "word " * 60_000, "de", "b", "x", 1, 1), (7, "x" * 200_000, "fr", "c", "x", 1, 1), (8, "one two", "es", "c", "x", 1, 1),
        (9, "日本語 🎉 ñandú \x00 ▁ <|im_end|>", "ja", "d", "x", 1, 1), (5, "another text under the same id as before", "en", "a", "x", 1, 1),
    ]
    return llm.createDataFrame(rows, DOCS).cache()


@pytest.fixture(scope="session")
def nothing(llm):
    return llm.createDataFrame([], DOCS)
