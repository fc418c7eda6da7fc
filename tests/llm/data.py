"""Small awkward tables for the corpus operators: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

WORDS = "the of and was river stone market garden window letter paper silver morning evening table forest".split()


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) if rnd.random() < 0.3 else f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    rnd = random.Random(seed)
    return " ".join(f"e{rnd.randrange(10**6)}" if rnd.random() < share else w for w in text.split(" "))


def documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars)."""
    base, long = prose(1, 300), prose(2, 6000)
    passage = prose(3, 120)
    texts = [base, base, edited(base, 4, 0.01), edited(base, 5, 0.02), edited(base, 6, 0.3), None, "", "  \n\t ", "one", "one two", "One Two",
             long, edited(long, 7, 0.005), prose(8, 200) + "\n" + passage + "\n" + prose(9, 150), prose(10, 90) + "\n" + passage,
             "a " * 500, "line of some words here\n" * 30, "é ñ ß 中文 \U0001F600 " * 40]
    texts += [prose(100 + i, 40 + i) for i in range(20)]
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base, None, None, 5), (None, prose(50, 60), "en", None, 1), (None, None, None, None, None)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
