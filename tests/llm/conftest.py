import random

import pytest

# Names that operators use inside, as further columns of the input.
CLASHES = ("doc", "key", "lines", "host", "text_key", "size", "place", "copies", "below", "fp", "root", "kept", "matches",
           "block", "shard", "slot", "held_out", "score", "start", "count", "removed_keys", "n_words")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with nulls in any column, empty and long texts, repeated rows and clashing columns."""

    def make(rows):
        names = ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]
        ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"`{c}` string" for c in CLASHES
        )
        full = [(i, t, "en", s, len(t or ""), *["x"] * len(CLASHES)) for i, t, s in rows]
        return spark.createDataFrame([dict(zip(names, r, strict=True)) for r in full], ddl).select(*names)

    return make


@pytest.fixture(scope="session")
def hostile():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Été", "ñandú", "x", "99", "#tag", "a|b"]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(n))

    same = prose(60)
    rows = [(k, prose(rng.randrange(5, 80)), rng.choice(["s1", "s2", None])) for k in range(40)]
    rows += [(100, None, "s1"), (101, "", None), (102, " \t\n\x0b ", "s2"), (103, "word", "s1")]
    rows += [(104, same, "s1"), (105, same, "s2"), (106, same + " end", "s1"), (107, same, None)]
    rows += [(108, prose(30), "s1")] * 3 + [(None, prose(25), "s2"), (None, prose(25), None), (None, None, None)]
    rows += [(109, "\n".join([prose(12)] * 9 + ["", prose(8)]), "s2"), (110, prose(9000), "s1")]
    return rows
