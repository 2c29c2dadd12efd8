"""Awkward rows that every operator must take."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, `row` int, id string, size string, "
        "`key` string, part string, n string, copies string, mark string, digest string, fp string, score string, `a.b` int")


def words(text):
    return WORD.findall(text or "")


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéøß") for _ in range(rng.randint(1, 8))) for _ in range(n))


def document_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, shared passages and copies."""
    passage = sentence(1, 60)
    long = sentence(2, 30_000)
    texts = {
        1: sentence(10, 80) + " " + passage, 2: passage + "\t" + sentence(11, 40), 3: sentence(12, 200),
        4: sentence(12, 200) + " x", 5: "", 6: None, 7: " \n\t ", 8: "one two", 9: "ONE two", 10: long,
        11: long + " tail " + passage, 12: "same " * 500, 13: "same " * 300 + sentence(13, 60),
        14: "line one is here\n" * 20 + sentence(14, 90), 15: sentence(15, 120) + " ### *** $$$ | < >",
        16: "\x85   nbsp\x1cx \U0001F600 I'M don't <|endoftext|>, ΑΣ İ", 17: sentence(17, 90), 18: sentence(17, 90),
    }
    rows = [(i, t, ["en", "de", None][i % 3], ["b", "a", None, "B", "\U0001F600"][i % 5], None if t is None else len(t)) for i, t in texts.items()]
    rows += [rows[2], rows[2], (3, sentence(18, 70), "en", "a", None), (None, sentence(19, 60), "en", "a", 5),
             (None, passage, None, None, None), (None, None, None, None, None), (-5, passage + " " + sentence(20, 50), "de", "b", 9)]
    rows += [(i, sentence(100 + i, 60 + i % 7), "en", "a", None) for i in range(30, 70)]
    return rows


def documents(spark, rows=None):
    rows = document_rows() if rows is None else rows
    return spark.createDataFrame([(*r, 1, *["x"] * 10, 2) for r in rows], DOCS).repartition(3)
