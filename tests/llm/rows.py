"""Small document tables for the tests: nulls, empty and long texts, copies, hot groups, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the river stone of light and home to green field in open night a bird with cloud on road by tree".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "a", "b", "en", "ol"]) for _ in range(n)).capitalize() + "."


def prose(seed: int, lines: int = 6, words: int = 14) -> str:
    rng = random.Random(seed)
    return "\n".join(sentence(rng, words) for _ in range(lines))


def changed(text: str, seed: int, n: int) -> str:
    """``text`` with ``n`` words replaced."""
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def frame(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [
        (r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s1")), len(r[1]) if r[1] is not None else None) for r in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    """Null id, null text, empty text, blanks, a very long text, repeated rows, non-Latin text."""
    long_text = prose(5, 400, 20)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\n  "),
        (4, long_text),
        (None, prose(6)),
        (None, None),
        (7, prose(7)),
        (7, prose(7)),
        (8, "Ünïcödé ñandú 中文字符 и русский текст\n" + prose(8, 2)),
        (9, "word"),
    ]
