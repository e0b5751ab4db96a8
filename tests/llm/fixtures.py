"""Small tables with the awkward rows every operator must take, and brute-force helpers."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: documents with extra columns whose names operators use for results
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, score double, keeper string, "
          "spans string, copies string, n_lines int, node string, items string, label string, id string")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, 1))) if w else frozenset()


def documents(spark, texts):
    """texts: (doc_id, text) pairs, or rows with lang and source too."""
    rows = []
    for i, r in enumerate(texts):
        doc_id, text, lang, source = (*r, "en", f"s{i % 3}")[:4]
        rows.append((doc_id, text, lang, source, None if text is None else len(text), None, None, "x", "y", None, 3, "n", None, "l", "i"))
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


AWKWARD = [(None, None), (None, "some text without an id"), (901, None), (902, ""), (903, " \n\n "), (904, "one"), (905, "ÄÖ ß 中文 😀"),
           (906, "same row here"), (906, "same row here"), (907, "long " * 30000), (908, "a.b!c?\n\n.\n")]
