"""Small documents for the tests of the training-data operators."""

import random

SCHEMA = "doc_id long, text string, lang string, n_words long, kept boolean, id string, chunk string, rest string, block long, spans string"


def words(n, seed=0, size=400):
    r = random.Random(seed)
    return [f"{'abcdefghij'[r.randrange(10)]}w{r.randrange(size)}" for _ in range(n)]


def texts():
    base = " ".join(words(120, 1))
    near = base.replace(words(120, 1)[60], "changed", 1)
    passage = " ".join(words(60, 2))
    long = " ".join(words(30_000, 3, 20_000))
    return {
        0: base, 1: base, 2: near, 3: None, 4: "", 5: " \n\t\r\x0b\x0c ", 6: "one", 7: "two words",
        8: f"{' '.join(words(40, 4))} {passage} {' '.join(words(40, 5))}", 9: f"start\n{passage}\nend and more",
        10: long, 11: "line a b c\n" * 30, 12: "spam " * 200, 13: f"Ünïcödé 文字 😀 é {base[:300]}",
        14: passage + " " + passage, 15: "#" * 300 + " " + base, 16: "a" * 5000, 17: "x\x00y   z\x85w",
    }


def frame(spark, rows=None, repeat=True):
    """Documents with columns whose names clash with the operators' own, repeated
    rows and a null id."""
    t = texts() if rows is None else rows
    data = [(i, x, "en", 5, False, "i", "c", "r", 1, "s") for i, x in t.items()]
    if repeat:
        data += [data[0], (None, "no id here", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
