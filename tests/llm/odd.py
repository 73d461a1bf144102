"""Small tables with what real ones hold at worst."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha") for b in ("a", "es", "ly", "ti", "or", "wh")]
BENCH = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi"


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(n))


def rows():
    base, long = prose(1, 120), prose(2, 30000)
    near = base.split()
    near[60] = "changed"
    passage = prose(3, 60)
    texts = {
        0: base, 1: base, 2: " ".join(near), 3: None, 4: "", 5: " \t\n ", 6: "one", 7: "one", 8: "One two three four",
        9: long, 10: long, 11: "x" * 50000, 12: "é" * 300 + " ñandú", 13: prose(4, 40) + "\n" + passage,
        14: passage + "  " + prose(5, 50), 15: prose(6, 30) + " " + BENCH + " " + prose(7, 30), 16: BENCH.upper(),
        17: "short item", 18: "a short item here", 19: "mail me: a.b@c.org, +49 30 1234567 or 10.0.0.1!",
        20: "same same same same same same same same same same same same same same same same", 21: "  x\u0085y",
        22: "4111 1111 1111 1111 and https://x.org/a?b=c. IBAN: DE4412345678", 23: prose(8, 13), 24: prose(8, 13) + " tail",
        25: "one two three four five", 26: "one two three four five", 27: "ONE TWO THREE FOUR FIVE six",
    }
    out = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    out += [(None, base, None, None, None), (None, passage, None, None, None), (0, "another text of id zero", None, "s", 1)]
    return out + [(30, prose(9, 20), "en", "s", 1)] * 2


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def clashing(spark):
    """The documents with extra columns that bear the names of what operators add or use."""
    docs = documents(spark)
    names = ("score", "features", "spans", "redacted", "block", "at", "row", "ids", "decoded", "label", "part", "others", "_at",
             "words", "text_hash", "kept", "vector", "raw", "n_words", "key", "node", "size")
    return docs.selectExpr("*", *[f"'{c}' as `{c}`" for c in names])


def nothing(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)
