"""Small tables and plain re-computations for the tests of this folder."""

import re

WORD = re.compile("[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def documents(spark, texts, sources=None):
    """A documents table with ids 0, 1, 2, ... and nulls where the text is null."""
    rows = [(i, t, None if t is None else "en", (sources or ["a"])[i % len(sources or ["a"])],
             None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def edge_texts():
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    return [None, "", " \n\t ", "one", "one two", "Same text of some words that comes twice in this very table here",
            "Same text of some words that comes twice in this very table here", "é漢字 \u00a0x\u2581y \U0001F600 z",
            "a" * 5000, long, "line one\nline one\n\nline one\nend"]
