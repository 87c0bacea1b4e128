"""Rows and brute-force helpers of the tests in this folder."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lowered(text))


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def near_groups(rows):
    """Smallest reachable doc_id of each (doc_id, text), by all pairs."""
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in rows}


LONG = " ".join(f"word{k % 977} and{k % 31}." for k in range(30_000))
#: nulls in any column, empty, white-space and very long texts, ties, repeated rows
ODD = [
    (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
    (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
    (1, "the QUICK brown fox jumps over the lazy dog again and again.", "en", "a", None),
    (2, None, None, None, None),
    (3, "", "en", "", 0),
    (4, " \t\n ", "en", "b", 4),
    (None, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
    (None, None, "en", "b", None),
    (5, LONG, "en", "b", len(LONG)),
    (6, LONG + " tail", "en", "b", len(LONG) + 5),
    (7, "ça été   naïve 日本語 <|endoftext|> 　x", "fr", "b", 30),
    (8, "one", "en", "c", 3),
    (9, "one", "en", "c", 3),
    (10, "a b c d", "en", "c", 7),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
