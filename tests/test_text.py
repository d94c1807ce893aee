import pytest
from pyspark.sql import functions as F

from polyeval.functions import text as TX
from naive_metrics import clean


CASES = [
    "plain text  ",
    "<think>a</think> answer",
    "<think>x</think> y</think>  final\n",
    "<think> never closed",
    "a\n</think>\nline one\nline two\n",
    "　  wide spaces  ",
    "",
    "</think>",
]


def test_clean_translation_matches_regex(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(CASES)], "i int, t string")
    got = {r["i"]: r["c"] for r in df.select("i", TX.clean_translation("t").alias("c")).collect()}
    for i, c in enumerate(CASES):
        assert got[i] == clean(c), (i, c)


def test_stringify_and_missing(spark):
    df = spark.createDataFrame([(None, "x"), ("a", ""), ("b", "1.5"), ("c", "NaN"), ("d", None)],
                               "t string, m string")
    rows = df.select(TX.stringify_missing("t").alias("s"), TX.is_missing_numeric("m").alias("miss")).collect()
    assert [r["s"] for r in rows] == ["nan", "a", "b", "c", "d"]
    assert [r["miss"] for r in rows] == [True, True, False, True, True]


@pytest.mark.parametrize("pair,ok", [("eng-fra", True), ("eng", False), ("eng-fra-x", False)])
def test_split_pair(spark, pair, ok):
    df = spark.createDataFrame([(pair,)], "p string")
    s, t, v = TX.split_pair("p")
    r = df.select(s.alias("s"), t.alias("t"), v.alias("v")).collect()[0]
    assert r["v"] == ok
    if ok:
        assert TX.make_pair(F.lit(r["s"]), F.lit(r["t"])) is not None
        assert f'{r["s"]}-{r["t"]}' == pair


def test_native_tokenizers_match_python(spark):
    import random

    from polyeval.functions import tokenize as TK
    rnd = random.Random(5)
    alphabet = list("ab Z9.,-&;()[]{}<>'\"$/\\\n\tü猫") + ["&amp;", "&quot;", "<skipped>", "-\n", "  "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", TK.bleu_tokens("t", "13a").alias("a"), TK.bleu_tokens("t", "char").alias("c"),
                    TK.bleu_tokens("t", "none").alias("n"), TK.chrf_chars("t").alias("cc"),
                    TK.chrf_words("t").alias("w"), TK.bleu_token_string("t").alias("s")).collect()
    for r in got:
        t = texts[r["i"]]
        assert list(r["a"]) == TK.py_13a(t), t
        assert r["s"] == " ".join(TK.py_13a(t)), t
        assert list(r["c"]) == TK.py_char(t), t
        assert list(r["n"]) == TK.py_none(t), t
        assert r["cc"] == TK.py_chrf_chars(t), t
        assert list(r["w"]) == TK.py_chrf_words(t), t


def test_round_half_even_on_exact_ties(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (12.3456,)], "x double")
    got = [r["r"] for r in df.select(TX.round_half_even(F.col("x"), 2).alias("r")).collect()]
    assert got == [round(0.125, 2), round(0.375, 2), 2.5, round(12.3456, 2)]


def test_prompt_templates_and_variant(spark):
    from polyeval import registry
    from polyeval.sources.corpus import build_prompt, chat_turn
    models = registry.models_df(spark, {"Phi-4": "plain"}).select("model", "prompt_variant")
    df = models.filter("model in ('Phi-4', 'Qwen3-4B')").withColumn("name", F.lit("French")) \
               .withColumn("source", F.lit("Hello."))
    got = {r["model"]: (r["p"], r["chat"]) for r in
           df.select("model", build_prompt(df, "name", "source", "prompt_variant").alias("p"),
                     chat_turn(build_prompt(df, "name", "source")).alias("chat")).collect()}
    assert got["Qwen3-4B"][0] == registry.PROMPT_TEMPLATES["thinking_off"].format(name="French", text="Hello.")
    assert got["Phi-4"][0] == registry.PROMPT_TEMPLATES["plain"].format(name="French", text="Hello.")
    assert got["Phi-4"][1][0]["role"] == "user"
