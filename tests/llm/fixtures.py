"""Small documents with every awkward case."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard string"
SYLLABLES = {"en": "the of ing er and tion ent re hat is".split(), "fr": "le é eau que ment oi eux ch de ai".split(), "de": "der ung sch ein lich zu keit ö ge die".split()}


def prose(rng, lang, words):
    parts = SYLLABLES[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


def documents(n=60, seed=1):
    """Prose in three languages, then the awkward rows; columns score and shard clash with added names."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = prose(rng, lang, rng.randint(60, 200))
        rows.append((i, text, lang, f"s{i % 4}", len(text), 0.5, "x"))
    long = prose(rng, "en", 30_000)
    rows += [
        (1000, None, "en", "s0", 0, None, None),
        (1001, "", None, None, 0, None, None),
        (1002, " \t\n\u000b ", "en", "s1", 5, None, None),
        (1003, "1234 !!! 5", None, "s1", 10, None, None),
        (1004, long, "en", "s2", len(long), 1.0, "y"),
        (1005, rows[0][1], rows[0][2], "s3", 5, None, None),
        (1006, "one", "en", "s3", 3, None, None),
        (None, rows[1][1], "en", "s0", 1, None, None),
        (7, rows[7][1], rows[7][2], "s3", 1, 0.5, "x"),
    ]
    return rows
