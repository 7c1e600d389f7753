"""Small tables with nulls, empty and long texts, ties, repeated rows and odd extra columns."""

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank string, copies string, component_id string, shard string, n_removed string, n_words string, bin string, kept string"


def odd_rows():
    clean = "The house of the river and the garden is an old one that was in the town by the sea for a long time with all of its trees and fields."
    other = "A small ship from the north came to the harbour on that day and it was not seen again by the people of this land or of an other."
    long = "\n".join(f"Line {k} of the long text is for the test of it and {k * 7} is in the line." for k in range(3000))
    lines = "first line here\nsecond line here\nthird line here\nfourth line here"
    texts = [clean, clean, None, "", "   \n\t ", "word", other, lines, lines + "\nfifth line here", long, "\n\n\n\n", "é" * 3000, clean + " More of it.", None, "a b c d"]
    rows = [(k, t, "en", f"s{k % 3}" if k % 5 else None, len(t) if t is not None else None, *["x"] * 8) for k, t in enumerate(texts)]
    rows += [(None, clean, None, None, None, *["x"] * 8), (6, other, "en", "s0", 1, *["y"] * 8), (6, "another text under a used id", "en", "s0", 1, *["z"] * 8)]
    return rows


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
