"""Plain-Python metric implementations written from the published metric
definitions, used only by tests as an independent check of the Spark plans."""

from __future__ import annotations

import math
import re
from collections import Counter

PUNCT = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def tok13a(line: str) -> list[str]:
    line = line.rstrip()
    line = line.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    if "&" in line:
        line = line.replace("&quot;", '"').replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
    line = f" {line} "
    line = re.sub(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 ", line)
    line = re.sub(r"([^0-9])([\.,])", r"\1 \2 ", line)
    line = re.sub(r"([\.,])([^0-9])", r" \1 \2", line)
    line = re.sub(r"([0-9])(-)", r"\1 \2 ", line)
    return line.split()


def ngrams(toks, n):
    return Counter(tuple(toks[i:i + n]) for i in range(len(toks) - n + 1))


def corpus_bleu(hyps, refs, tok=tok13a, max_order=4):
    correct = [0] * max_order
    total = [0] * max_order
    sys_len = ref_len = 0
    for h, r in zip(hyps, refs):
        ht, rt = tok(h), tok(r)
        sys_len += len(ht)
        ref_len += len(rt)
        for n in range(1, max_order + 1):
            hc, rc = ngrams(ht, n), ngrams(rt, n)
            total[n - 1] += sum(hc.values())
            correct[n - 1] += sum(min(c, rc[g]) for g, c in hc.items())
    if sys_len < ref_len:
        bp = math.exp(1 - ref_len / sys_len) if sys_len > 0 else 0.0
    else:
        bp = 1.0
    if not any(correct):
        return 0.0
    prec = [0.0] * max_order
    smooth = 1.0
    for n in range(max_order):
        if total[n] == 0:
            break
        if correct[n] == 0:
            smooth *= 2
            prec[n] = 100.0 / (smooth * total[n])
        else:
            prec[n] = 100.0 * correct[n] / total[n]
    return bp * math.exp(sum(math.log(p) if p else -9999999999 for p in prec) / max_order)


def _words(sent):
    out = []
    for w in sent.split():
        if len(w) == 1:
            out.append(w)
        elif w[-1] in PUNCT:
            out += [w[:-1], w[-1]]
        elif w[0] in PUNCT:
            out += [w[0], w[1:]]
        else:
            out.append(w)
    return out


def corpus_chrf(hyps, refs, char_order=6, word_order=0, beta=2):
    order = char_order + word_order
    stats = [0] * (3 * order)
    for h, r in zip(hyps, refs):
        hs, rs = "".join(h.split()), "".join(r.split())
        hc = [Counter(hs[i:i + n] for i in range(len(hs) - n + 1)) for n in range(1, char_order + 1)]
        rc = [Counter(rs[i:i + n] for i in range(len(rs) - n + 1)) for n in range(1, char_order + 1)]
        if word_order:
            hw, rw = _words(h), _words(r)
            hc += [ngrams(hw, n) for n in range(1, word_order + 1)]
            rc += [ngrams(rw, n) for n in range(1, word_order + 1)]
        for i, (a, b) in enumerate(zip(hc, rc)):
            m = sum(min(c, b[g]) for g, c in a.items() if g in b)
            stats[3 * i] += sum(a.values()) if b else 0
            stats[3 * i + 1] += sum(b.values())
            stats[3 * i + 2] += m
    factor = beta ** 2
    ap = ar = 0.0
    eff = 0
    for i in range(order):
        nh, nr, nm = stats[3 * i: 3 * i + 3]
        if nh > 0 and nr > 0:
            ap += nm / nh
            ar += nm / nr
            eff += 1
    if eff:
        ap /= eff
        ar /= eff
    if ap + ar:
        return 100 * (1 + factor) * ap * ar / (factor * ap + ar)
    return 0.0


def rouge_tokens(text):
    return [t for t in re.sub(r"[^a-z0-9]+", " ", text.lower()).split() if re.match(r"^[a-z0-9]+$", t)]


def lcs(a, b):
    if not a or not b:
        return 0
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def rouge_l_f(hyp, ref):
    h, r = rouge_tokens(hyp), rouge_tokens(ref)
    if not h or not r:
        return 0.0
    m = lcs(r, h)
    p, rc = m / len(h), m / len(r)
    return 0.0 if p + rc == 0 else 2 * p * rc / (p + rc)


def clean(t):
    return re.sub(r"(?s).*?</think>", "", t).strip()
