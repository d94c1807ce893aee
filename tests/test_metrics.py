import random

import pytest
from pyspark.sql import functions as F

import naive_metrics as N
from polyeval.functions.align import lcs_length, meteor_segment
from polyeval.operators.bleu import corpus_bleu
from polyeval.operators.chrf import corpus_chrf
from polyeval.operators.meteor import meteor
from polyeval.operators.rouge import rouge_l

KEYS = ["unit"]
WORDS = "the a cat dog sat on mat , . -- 3.5 1,000 big small red house Haus maison ( ) é über 9-5 it's".split()


def _corpus(seed, n_units=6, n_seg=25):
    rnd = random.Random(seed)
    rows = []
    for u in range(n_units):
        for s in range(n_seg):
            ref = " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 14)))
            hyp = " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 14)))
            if rnd.random() < 0.3:
                hyp = ref
            rows.append((f"u{u}", s, hyp, ref))
    return rows


def _df(spark, rows, parts=None):
    df = spark.createDataFrame(rows, "unit string, seg_id long, hyp string, ref string")
    return df.repartition(parts) if parts else df


def _by_unit(rows):
    out = {}
    for u, _, h, r in rows:
        out.setdefault(u, ([], []))
        out[u][0].append(h)
        out[u][1].append(r)
    return out


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_bleu_chrf_against_naive(spark, parts):
    rows = _corpus(7)
    df = _df(spark, rows, parts)
    b = {r["unit"]: r["bleu"] for r in corpus_bleu(df, KEYS, digits=None).collect()}
    c = {r["unit"]: r["chrf"] for r in corpus_chrf(df, KEYS, digits=None).collect()}
    cpp = {r["unit"]: r["chrf"] for r in corpus_chrf(df, KEYS, word_order=2, digits=None).collect()}
    for u, (h, r) in _by_unit(rows).items():
        assert b[u] == pytest.approx(N.corpus_bleu(h, r), abs=1e-9)
        assert c[u] == pytest.approx(N.corpus_chrf(h, r), abs=1e-9)
        assert cpp[u] == pytest.approx(N.corpus_chrf(h, r, word_order=2), abs=1e-9)


def test_metric_goldens(spark):
    rows = [("same", 0, "The cat sat on the mat.", "The cat sat on the mat."),
            ("empty", 0, "", "The cat sat on the mat."),
            ("short", 0, "The cat", "The cat sat on the mat."),
            ("cjk", 0, "猫はマットの上に座った", "猫はマットの上に座った")]
    df = _df(spark, rows)
    b = {r["unit"]: r for r in corpus_bleu(df, KEYS, digits=None).collect()}
    c = {r["unit"]: r["chrf"] for r in corpus_chrf(df, KEYS, digits=None).collect()}
    rl = {r["unit"]: r["rouge_l"] for r in rouge_l(df, KEYS, digits=None).collect()}
    assert b["same"]["bleu"] == pytest.approx(100.0)
    assert c["same"] == pytest.approx(100.0)
    assert rl["same"] == pytest.approx(1.0)
    assert b["empty"]["bleu"] == 0.0 and c["empty"] == 0.0 and rl["empty"] == 0.0
    # brevity penalty: 2 of 7 tokens, all matching -> exp(1 - 7/2) scales the score
    assert b["short"]["sys_len"] == 2 and b["short"]["ref_len"] == 7
    assert b["short"]["bleu"] == pytest.approx(N.corpus_bleu(["The cat"], ["The cat sat on the mat."]))
    assert rl["cjk"] == 0.0   # non-Latin text has no [a-z0-9] tokens
    assert c["cjk"] == pytest.approx(100.0)


def test_rouge_l_against_naive(spark):
    rows = _corpus(11, n_units=4, n_seg=30)
    got = {r["unit"]: r["rouge_l"] for r in rouge_l(_df(spark, rows, 3), KEYS, digits=None).collect()}
    for u, (h, r) in _by_unit(rows).items():
        exp = sum(N.rouge_l_f(a, b) for a, b in zip(h, r)) / len(h)
        assert got[u] == pytest.approx(exp, abs=1e-12)


def test_lcs_bitparallel_random():
    rnd = random.Random(3)
    for _ in range(300):
        a = [rnd.choice("abcde") for _ in range(rnd.randint(0, 40))]
        b = [rnd.choice("abcde") for _ in range(rnd.randint(0, 40))]
        assert lcs_length(a, b) == N.lcs(a, b)


def test_meteor_goldens(spark):
    assert meteor_segment("", "a b") == 0.0
    same = meteor_segment("the cat sat on the mat", "the cat sat on the mat")
    assert same == pytest.approx(1 - 0.5 * (1 / 6) ** 3)
    # stems match: cats ~ cat
    assert meteor_segment("cats", "cat") == pytest.approx(1 - 0.5)
    df = _df(spark, [("u", 0, "the cat sat on the mat", "the cat sat on the mat"), ("u", 1, "", "x")])
    m = meteor(df, KEYS, digits=None).collect()[0]["meteor"]
    assert m == pytest.approx(same / 2)


def test_meteor_synonym_table():
    # as in the reference scorer, the synonym stage sees the words left after
    # the stem stage in their stemmed form
    syn = {"big": frozenset({"huge"}), "huge": frozenset({"big"})}
    assert meteor_segment("a big house", "a huge house") < meteor_segment("a big house", "a huge house",
                                                                         synonyms=syn)


def test_packed_ngram_counts_equal_counters():
    """The numpy path (dense ids packed into 64-bit keys, one sort per order)
    against plain Counters, including alphabets too large to pack."""
    from polyeval.operators.ngram import _seg_stats, _seg_stats_counter
    rnd = random.Random(13)
    small = "ab c漢é"
    large = "".join(chr(0x4E00 + i) for i in range(3000))
    for alphabet, n_cases in ((small, 1500), (large, 60)):
        for _ in range(n_cases):
            a = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 400 if alphabet is large else 30)))
            b = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 400 if alphabet is large else 30)))
            spec = [(n, "char", n) for n in range(1, 7)]
            assert _seg_stats({"char": a}, {"char": b}, spec, True) == \
                _seg_stats_counter({"char": a}, {"char": b}, spec, True)
            ta, tb = a.split() or list(a[:20]), b.split() or list(b[:20])
            spec = [(n, "tok", n) for n in range(1, 5)]
            assert _seg_stats({"tok": ta}, {"tok": tb}, spec, False) == \
                _seg_stats_counter({"tok": ta}, {"tok": tb}, spec, False)


def test_bleu_with_sentencepiece_model(spark, tmp_path):
    """tokenizer='spm': a user-supplied SentencePiece model (here a tiny one
    trained for the test) tokenizes inside the statistics task."""
    spm = pytest.importorskip("sentencepiece")
    rnd = random.Random(21)
    corpus = tmp_path / "train.txt"
    lines = [" ".join(rnd.choice(WORDS) for _ in range(12)) for _ in range(400)]
    corpus.write_text("\n".join(lines))
    prefix = str(tmp_path / "m")
    spm.SentencePieceTrainer.train(input=str(corpus), model_prefix=prefix, vocab_size=40,
                                   model_type="unigram", character_coverage=1.0)
    model = prefix + ".model"
    sp = spm.SentencePieceProcessor(model_file=model)
    rows = _corpus(5, n_units=3, n_seg=15)
    got = {r["unit"]: r["bleu"] for r in
           corpus_bleu(_df(spark, rows), KEYS, tokenizer="spm", spm_model=model, digits=None).collect()}

    def tok(s):
        return " ".join(sp.encode(s.rstrip(), out_type=str)).split()
    for u, (h, r) in _by_unit(rows).items():
        assert got[u] == pytest.approx(N.corpus_bleu(h, r, tok=tok), abs=1e-9)


def test_public_spm_model_goes_with_the_job(spark, tmp_path):
    """A real model, and one whose file is gone when the tasks run."""
    P = pytest.importorskip("public_tokenizers")
    spm = pytest.importorskip("sentencepiece")
    import shutil

    from polyeval.functions.tokenize import bleu_signature
    model = str(tmp_path / "m.model")
    shutil.copy(P.path("piece_bpe_32k.model"), model)
    rows = [("u", i, f"le chat {i} est assis là.", f"le chat {i} était assis, là") for i in range(12)]
    sp = spm.SentencePieceProcessor(model_file=model)
    signature = bleu_signature("flores200", model)
    assert signature.startswith("nrefs:1|case:mixed|tok:flores200") and signature != bleu_signature("13a")
    lazy = corpus_bleu(_df(spark, rows), KEYS, tokenizer="flores200", spm_model=model, digits=None)
    (tmp_path / "m.model").rename(tmp_path / "away.model")
    cut = [(*r[:2], " ".join(sp.encode(r[2], out_type=str)), " ".join(sp.encode(r[3], out_type=str))) for r in rows]
    want = corpus_bleu(_df(spark, cut), KEYS, tokenizer="none", digits=None).first().bleu
    assert lazy.first().bleu == pytest.approx(want)
    with pytest.raises(Exception):
        corpus_bleu(_df(spark, rows), KEYS, tokenizer="flores200", spm_model=model)


def test_words_are_those_of_all_rules_one_by_one():
    """The rules that a text can't need are left out, and the last period is found from the end."""
    import random

    from polyeval.functions import align
    chance = random.Random(7)
    signs = list("aabSsdlT .,,..  '''\"\"``-:;!?()[]{}<>«“‘„»”’@#$%&\n\t01Σé")
    for _ in range(5000):
        text = "".join(chance.choice(signs) for _ in range(chance.randrange(40)))
        t = f" {text} "
        for pat, rep in align._TB_RULES:
            t = pat.sub(rep, t)
        assert align._words(text) == t.split(), text
    assert align._lower(["ΑΣ", "Σ'", "İ"]) == ["ας", "σ'", "i̇"]
    assert len(align._active_rules(frozenset("."))) == 2
