"""Small tables with nulls, empty and long texts, repeated rows and clashing columns."""

import random
import re

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, row int, key string"


def words(text, pattern):
    return pattern.findall((text or "").translate(LOWER))


def documents(spark, texts, lang="en", source="s"):
    """Texts, or pairs of id and text, as a documents table with columns that operators also make."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, lang, source, len(t or ""), 7.0, "x", 1, "k") for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, size, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(size))


EDGES = [None, "", " \t\n", "one", "one", "Ünïcode ÉÉ words here", "a b c", "x" * 5000, prose(1, 30_000), "\x00 nul\x00l", "a\x0bb\x0cc"]
