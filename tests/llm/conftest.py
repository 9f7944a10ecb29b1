from __future__ import annotations

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0d]+")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from cartwheel.llm.ship import ship
    ship(spark)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns of clashing names."""
    def make(rows, lang="en", source="s"):
        schema = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, component_id string, "
                  "path string, spans int, length string, kept string, g string, n long, x long")
        return spark.createDataFrame([(i, t, lang, source, len(t or ""), -1, "c", "p", 7, "l", "k", "g", 5, 6) for i, t in rows], schema)
    return make


def words(text):
    return WORD.findall(text or "")


#: Texts every operator must take: null, empty, white space, one long word, line feeds, long.
ODD = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "x" * 5000), (5, "\n\n\n"), (6, "a b c d e f " * 3000), (None, "no id at all here"), (7, "same text twice"), (7, "same text twice")]
