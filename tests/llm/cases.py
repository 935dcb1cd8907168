"""Rows that every operator has to take: nulls, empty and long texts, ties, repeats, and extra columns with clashing names."""

SCHEMA = "doc_id long, text string, n_tokens long, spans string, component_id long, kept string, node string, _block long, _blob string, _cut int, _gone long, _id long, blob string"
BENCH = "item_id long, text string"
WORDS = [f"wort{i}" if i % 3 else f"Ünï{i}" for i in range(400)]


def passage(a, n):
    return " ".join(WORDS[(a + i) % len(WORDS)] for i in range(n))


TEXTS = {
    0: passage(0, 60),
    1: None,
    2: "",
    3: "   \n\t ",
    4: "one",
    5: passage(0, 60),
    6: passage(100, 45) + " , " + passage(10, 30) + "!",
    7: passage(10, 30),
    8: "ß" * 500,
    9: passage(200, 3000),
    10: passage(200, 3000) + " changed",
    11: "a\u0000b   \U0001f600 é",
    12: " ".join(["same"] * 300),
    13: " ".join(["same"] * 280),
    14: "password = hunter22; AKIA" + "Q" * 16 + " " + "0123456789abcdef" * 2,
    15: "x",
}


def documents(spark, texts=None):
    rows = [(i, t, 1, "s", 2, "k", "n", 3, "b", 4, 5, 6, "c") for i, t in (texts or TEXTS).items()]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
