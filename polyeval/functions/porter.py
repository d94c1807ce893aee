"""Porter stemmer (M. F. Porter, "An algorithm for suffix stripping", 1980),
with the common extensions: short words (<= 2 letters) are kept, a few
irregular forms are looked up first, 'ies' -> 'ie' for four-letter words,
'y' -> 'i' only after a consonant that is not the first letter, and the
'alli', 'fulli', 'logi' step-2 rules. Used by the METEOR stem stage."""

from __future__ import annotations

from functools import lru_cache

# FIXED VALUES: irregular forms.
_IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

_VOWELS = frozenset("aeiou")


def _cons(w: str, i: int) -> bool:
    c = w[i]
    if c in _VOWELS:
        return False
    if c == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _m(stem: str) -> int:
    """Number of VC sequences in the stem."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        v = not _cons(stem, i)
        if prev_vowel and not v:
            m += 1
        prev_vowel = v
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) >= 3:
        return (_cons(w, len(w) - 3) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 1)
                and w[-1] not in "wxy")
    if len(w) == 2:  # extension: a two-letter vowel-consonant word
        return not _cons(w, 0) and _cons(w, 1)
    return False


def _step1a(w):
    if w.endswith("ies") and len(w) == 4:
        return w[:-3] + "ie"
    for suf, rep in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(suf):
            return w[: len(w) - len(suf)] + rep
    return w


def _step1b(w):
    if w.endswith("ied"):
        return w[:-3] + ("ie" if len(w) == 4 else "i")
    if w.endswith("eed"):
        stem = w[:-3]
        return stem + "ee" if _m(stem) > 0 else w
    for suf in ("ed", "ing"):
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            if not _has_vowel(stem):
                return w
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_cons(stem) and stem[-1] not in "lsz":
                return stem[:-1]
            if _m(stem) == 1 and _cvc(stem):
                return stem + "e"
            return stem
    return w


def _step1c(w):
    if w.endswith("y") and len(w) > 2 and _cons(w, len(w) - 2):
        return w[:-1] + "i"
    return w


_STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
          ("ful", ""), ("ness", "")]
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
          "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _by_length(pairs):
    """Suffix tables keyed by length, longest first: the longest matching
    suffix is found with one dict lookup per length."""
    out: dict[int, dict[str, str]] = {}
    for suf, rep in pairs:
        out.setdefault(len(suf), {})[suf] = rep
    return sorted(out.items(), reverse=True)


_STEP2_T = _by_length(_STEP2)
_STEP3_T = _by_length(_STEP3)
_STEP4_T = _by_length([(x, "") for x in _STEP4])


def _longest(w, table):
    n = len(w)
    for length, d in table:
        if n >= length:
            rep = d.get(w[n - length:])
            if rep is not None:
                return w[: n - length], w[n - length:], rep
    return None


def _step2(w):
    hit = _longest(w, _STEP2_T)
    if hit is None:
        return w
    stem, suf, rep = hit
    if suf == "logi":  # its l counts as part of the stem
        return w[:-1] if _m(stem + "l") > 0 else w
    if suf == "alli" and _m(stem) > 0:
        return _step2(stem + "al")
    return stem + rep if _m(stem) > 0 else w


def _step3(w):
    hit = _longest(w, _STEP3_T)
    if hit is None:
        return w
    stem, _suf, rep = hit
    return stem + rep if _m(stem) > 0 else w


def _step4(w):
    hit = _longest(w, _STEP4_T)
    if hit is None:
        return w
    stem, suf, _rep = hit
    if suf == "ion":
        return stem if _m(stem) > 1 and stem.endswith(("s", "t")) else w
    return stem if _m(stem) > 1 else w


def _step5(w):
    if w.endswith("e"):
        stem = w[:-1]
        m = _m(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    if w.endswith("ll") and _m(w[:-1]) > 1:
        w = w[:-1]
    return w


@lru_cache(maxsize=1 << 18)
def stem(word: str) -> str:
    w = word.lower()
    if w in _IRREGULAR:
        return _IRREGULAR[w]
    if len(w) <= 2:
        return w
    for step in (_step1a, _step1b, _step1c, _step2, _step3, _step4, _step5):
        w = step(w)
    return w
