"""Per-segment helpers run inside Arrow UDFs: LCS length (ROUGE-L) and the
METEOR alignment. Each works on one segment pair; Spark does the rest."""

from __future__ import annotations

import re
from functools import lru_cache

from .porter import stem as porter_stem


def lcs_length(a: list, b: list) -> int:
    """Longest common subsequence length, bit-parallel (Hyyrö 2004): one
    big-integer add/or/and per token of ``b`` over a bit vector as long as
    ``a``, i.e. O(len(a) * len(b) / word size)."""
    if not a or not b:
        return 0
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        m = masks.get(y)
        if m is None:
            continue
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def rouge_l_f(hyp_tokens: list[str], ref_tokens: list[str]) -> float:
    if not hyp_tokens or not ref_tokens:
        return 0.0
    lcs = lcs_length(ref_tokens, hyp_tokens)
    p, r = lcs / len(hyp_tokens), lcs / len(ref_tokens)
    return 0.0 if p + r == 0 else 2 * p * r / (p + r)


# Word tokenizer for METEOR in the style of the Penn Treebank tokenizer:
# quotes, punctuation and clitics are split off words.
_TB_RULES = [
    (re.compile(r"[«“‘„]"), r" \g<0> "),
    (re.compile(r'^"'), "``"),
    (re.compile(r"(``)"), r" \1 "),
    (re.compile(r'([ \(\[{<])(")'), r"\1 `` "),
    (re.compile(r"([:,])([^\d])"), r" \1 \2"),
    (re.compile(r"([:,])$"), r" \1 "),
    (re.compile(r"\.\.\."), r" ... "),
    (re.compile(r"[;@#$%&]"), r" \g<0> "),
    (re.compile(r'([^\.])(\.)([\]\)}>"\'»”’ ]*)\s*$'), r"\1 \2 \3 "),
    (re.compile(r"[?!]"), r" \g<0> "),
    (re.compile(r"([^'])' "), r"\1 ' "),
    (re.compile(r"[\]\[\(\)\{\}\<\>]"), r" \g<0> "),
    (re.compile(r"--"), r" -- "),
    (re.compile(r"[»”’]"), r" \g<0> "),
    (re.compile(r'"'), " '' "),
    (re.compile(r"(\S)(\'\')"), r"\1 \2 "),
    (re.compile(r"([^' ])('[sS]|'[mM]|'[dD]|') "), r"\1 \2 "),
    (re.compile(r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) "), r"\1 \2 "),
]


# Characters without which a rule cannot match: a rule is skipped when the
# text has none of them (the same result, fewer passes over long texts).
_TB_TRIGGERS = ["«“‘„", '"', "`", '"', ":,", ":,", ".", ";@#$%&", ".", "?!", "'", "[](){}<>", "-", "»”’", '"', "'",
                "'", "'"]

# A sentence ends at . ? or ! (and closing signs) before white space and anything
# but a lower-case letter; only at a sentence's end is a period split off.
_SENTENCE_END = re.compile(r"(?<=[.?!])([\])}\"'»”’]*)\s+(?=[^\W\d_a-zß-öø-ÿ]|[\"'«“‘„(\[])")


def sentences(text: str) -> list[str]:
    return _SENTENCE_END.sub("\\1\x00", text).split("\x00") if any(c in text for c in ".?!") else [text]


def word_tokenize(text: str) -> list[str]:
    return [w for s in sentences(text) for w in _words(s)]


_FREE = -2  # no match; one more is no position
_SPECIAL = frozenset("".join(_TB_TRIGGERS))
_FINAL_PERIOD = _TB_RULES[8][0]


@lru_cache(maxsize=1 << 14)
def _active_rules(special: frozenset) -> tuple:
    """The rules that a text with these special characters may need (the rules for double quotes
    put in backticks and apostrophes)."""
    if '"' in special:
        special = special | {"`", "'"}
    return tuple(rule for rule, trig in zip(_TB_RULES, _TB_TRIGGERS) if not special.isdisjoint(trig))


def _words(text: str) -> list[str]:
    t = f" {text} "
    for pat, rep in _active_rules(_SPECIAL.intersection(t)):
        if pat is _FINAL_PERIOD:  # only the last period can match: what follows it holds none
            at = t.rfind(".") - 1
            m = pat.match(t, at) if at >= 0 else None
            if m:
                t = f"{t[:at]}{m[1]} {m[2]} {m[3]} {t[m.end():]}"
        else:
            t = pat.sub(rep, t)
    return t.split()


def _pair_greedy(h_at, h_words: list[str], r_at, r_words: list[str], link: list[int], free: bytearray) -> None:
    """Match equal words one-to-one: scanning the hypothesis from its end,
    each word takes the last still-unmatched equal reference word. Per word
    that pairs occurrences from the end on both sides, so it is linear. ``h_at``, ``r_at``: the
    words' positions, ascending; ``link`` gets each matched hypothesis position's reference
    position, ``free`` loses that."""
    common = set(h_words).intersection(r_words)
    if not common:
        return
    waiting: dict[str, list[int]] = {w: [] for w in common}
    for j, w in zip(r_at, r_words):
        if w in common:
            waiting[w].append(j)
    for i, w in zip(reversed(h_at), reversed(h_words)):
        if w in common and waiting[w]:
            link[i] = j = waiting[w].pop()
            free[j] = 0


def _lower(tokens: list[str]) -> list[str]:
    """Each token in lower case (a space ends whatever the case of a letter depends on)."""
    return " ".join(tokens).lower().split(" ") if tokens else []


def meteor_segment(hyp: str, ref: str, alpha: float = 0.9, beta: float = 3.0, gamma: float = 0.5,
                   synonyms: dict[str, frozenset] | None = None) -> float:
    """METEOR of one segment: exact, then Porter-stem, then (optional)
    synonym matching, each one-to-one on the words left over (the synonym
    stage sees them stemmed, as the reference scorer does); F-mean with
    recall weight ``alpha``; fragmentation penalty gamma*(chunks/matches)^beta."""
    h, r = _lower(word_tokenize(hyp)), _lower(word_tokenize(ref))
    n_h, n_r = len(h), len(r)
    link, free = [_FREE] * n_h, bytearray(b"\x01") * n_r
    _pair_greedy(range(n_h), h, range(n_r), r, link, free)
    h_at, r_at = [i for i, j in enumerate(link) if j == _FREE], [j for j, f in enumerate(free) if f]
    h_stems, r_stems = [porter_stem(h[i]) for i in h_at], [porter_stem(r[j]) for j in r_at]
    _pair_greedy(h_at, h_stems, r_at, r_stems, link, free)
    if synonyms:
        h_left = [(i, w) for i, w in zip(h_at, h_stems) if link[i] == _FREE]
        r_left = [(j, w) for j, w in zip(r_at, r_stems) if free[j]]
        for i, j in _synonym_match(h_left, r_left, synonyms)[0]:
            link[i] = j
    m = n_h - link.count(_FREE)
    if m == 0 or n_h == 0 or n_r == 0:
        return 0.0
    p, rc = m / n_h, m / n_r
    fmean = p * rc / (alpha * p + (1 - alpha) * rc)
    chunks = sum([j != _FREE and j != before + 1 for before, j in zip([_FREE, *link], link)])
    penalty = gamma * (chunks / m) ** beta
    return (1 - penalty) * fmean


def _synonym_match(h, r, synonyms):
    matches, used_r = [], set()
    rest_h = []
    for i in range(len(h) - 1, -1, -1):
        hi, hw = h[i]
        sets = synonyms.get(hw, frozenset()) | {hw}
        hit = None
        for j in range(len(r) - 1, -1, -1):
            if j not in used_r and (r[j][1] in sets or synonyms.get(r[j][1], frozenset()) & sets):
                hit = j
                break
        if hit is None:
            rest_h.append((hi, hw))
        else:
            used_r.add(hit)
            matches.append((hi, r[hit][0]))
    return matches, rest_h[::-1], [x for k, x in enumerate(r) if k not in used_r]
