"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, copies."""

import random

SF_DIR = "/root/testdata/sf0.001"
#: Names that operators might use for columns of their own.
CLASHING = ("key", "token", "n", "score", "gone", "grams", "unit", "word", "row", "h", "part", "first", "hash")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, words=60):
    return " ".join(rng.choice("the of and river stone cloud light paper garden window seven kind".split()) + rng.choice("abcdefgh") for _ in range(words))


def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(5)
    base = prose(rng)
    long = "\n".join(prose(rng, 40) for _ in range(700))
    unbroken = "x1y" * 40_000
    rows = [
        (2**60, base), (2**60 + 1, base), (3, base + " and one more"), (3, base + " and one more"),
        (4, ""), (5, None), (None, base), (None, None), (None, ""), (6, " \t \n\n  \r\n"), (7, "one two"),
        (8, "one two"), (9, "Two words\nTWO words \n\x0btwo words"), (10, long), (11, long + " end"), (12, unbroken),
        (13, "Äpfel ÄPFEL    naïve\n<|endoftext|> ▁▁a  b\n"), (14, prose(rng) + "\n" + base), (-1, prose(rng)),
        (15, "  lead\n\n\ntrail   "), (15, "another text of fifteen"), (16, "The same long line here\n" * 5),
        (17, "the SAME long line here \nbut not this one of course"), (18, "a" * 9), (19, "a" * 9 + "é\n" + "a" * 9 + "é"),
    ]
    return [(i, text, None, None, None) for i, text in rows]


def texts(rows):
    return [(r.doc_id, r.text or "") for r in rows.collect()]


def tally(rows):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
