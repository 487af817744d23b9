"""Words and phrases of a sentiment run as one structure, applied to whole texts in a single scan.

``Vocabulary`` is built once on the driver from the word tables (bounded, see
``sentiment.MAX_WORDS``) and broadcast. A text is split once; a word that the
lexicon knows is scored from the words around it by dictionary look-ups, and
phrases are followed through a trie of words.
"""

from __future__ import annotations

import string

import pyarrow as pa

NO_PHRASE = (None, None)


class Vocabulary:
    """Valences, booster scalars, negations and a trie of phrases, all in lower case."""

    def __init__(self, valences, scalars, negations, idioms):
        self.valence = _largest((w, float(v)) for w, v in valences if v is not None)
        self.scalar = _largest((w, float(v)) for w, v in scalars if v is not None)
        self.negation = {w.lower() for w in negations if w is not None}
        #: word -> (valence, scalar, next words); a phrase ends where either number is there
        self.phrases: dict = {}
        for at, pairs in ((0, idioms), (1, [(w, v) for w, v in scalars if w is not None and " " in w])):
            for phrase, v in _largest((p, float(x)) for p, x in pairs if x is not None).items():
                self._grow(phrase.split(" "), at, v)

    def _grow(self, words, slot, value) -> None:
        level = self.phrases
        for k, w in enumerate(words):
            node = level.setdefault(w, [None, None, {}])
            if k == len(words) - 1:
                node[slot] = value
            level = node[2]

    def phrases_from(self, words, at) -> dict:
        """Length -> (valence, scalar) of the phrases of two or three words that begin at word ``at``."""
        found, level = {}, self.phrases
        for k in range(at, min(at + 3, len(words))):
            node = level.get(words[k])
            if node is None:
                break
            if k > at and (node[0] is not None or node[1] is not None):
                found[k - at + 1] = (node[0], node[1])
            level = node[2]
        return found


def _largest(pairs) -> dict:
    out: dict = {}
    for w, v in pairs:
        if w is not None:
            w = w.lower()
            out[w] = v if w not in out else max(v, out[w])
    return out


def split_words(text: str) -> list[str]:
    """V1: whitespace tokens, edge punctuation stripped unless that leaves two characters or fewer."""
    return [core if len(core := t.strip(string.punctuation)) > 2 else t for t in text.split()]


def _capital(word: str) -> bool:
    return word.upper() == word and word.lower() != word


class Scorer:
    """The rules V2-V6 over one vocabulary; ``rules`` and ``consts`` are the numbers of the method."""

    def __init__(self, vocabulary: Vocabulary, contrast: str, consts, rules):
        self.v, self.contrast, self.c, self.rules = vocabulary, contrast, consts, rules

    def hits(self, text: str):
        """Number of words, and ``(place, word, valence)`` of every lexicon word."""
        words = split_words(text)
        lows = [w.lower() for w in words]
        known = self.v.valence
        places = [i for i, w in enumerate(lows) if w in known]
        if not places:
            return len(words), []
        capitals = sum(map(str.isupper, text.split()))
        mixed = 0 < capitals < len(words)
        turn = lows.index(self.contrast) if self.contrast in lows else -1
        return len(words), [(i, words[i], self._contrasted(i, turn, self._valence(words, lows, i, mixed))) for i in places]

    def _contrasted(self, i: int, turn: int, v: float) -> float:
        if turn < 0 or i == turn:
            return v
        return v * (self.c["but_before"] if i < turn else self.c["but_after"])

    def _valence(self, words, lows, i, mixed) -> float:
        voc, c = self.v, self.c
        v = voc.valence[lows[i]]
        if mixed and _capital(words[i]):
            v = v + c["caps"] if v > 0 else v - c["caps"]
        for k in (1, 2, 3):
            if i >= k and lows[i - k] not in voc.valence:
                v = self._preceded(words, lows, i, k, v, mixed)
                if k == 3 and voc.phrases:
                    v = self._phrased(lows, i, v)
        if i > 0 and lows[i - 1] == "least" and "least" not in voc.valence and (i == 1 or lows[i - 2] not in ("at", "very")):
            v = v * c["negated"]
        if lows[i] in voc.scalar or (lows[i] == "kind" and lows[i + 1:i + 2] == ["of"]):
            return 0.0
        return v

    def _preceded(self, words, lows, i, k, v, mixed) -> float:
        """Effect of the word ``k`` places before: booster, then negation."""
        c, rules = self.c, self.rules
        low, boost = lows[i - k], self.v.scalar.get(lows[i - k])
        if boost is not None:
            step = -boost if v < 0 else boost
            if mixed and _capital(words[i - k]):
                step += c["caps"] if v > 0 else -c["caps"]
            v = v + step * c["damp"][k]
        p = lows[i - 1]
        if k == 2:
            if low == "never" and p in c["never_words"]:
                return v * rules.never_factor_2
            if rules.without_doubt and low == "without" and p == "doubt":
                return v
        if k == 3:
            if (low == "never" and lows[i - 2] in c["never_words"]) or p in c["never_words"]:
                return v * rules.never_factor_3
            if rules.without_doubt and low == "without" and "doubt" in (lows[i - 2], p):
                return v
        return v * c["negated"] if low in self.v.negation or "n't" in low else v

    def _phrased(self, lows, i, v) -> float:
        """Idioms set the valence (a following one wins), boosters of several words add to it."""
        voc = self.v
        p3, p2, p1, here = (voc.phrases_from(lows, i - k) for k in (3, 2, 1, 0))
        spans = ((here, 3), (here, 2), (p1, 2), (p2, 3), (p2, 2), (p3, 3), (p3, 2))
        v = next((x for span, n in spans if (x := span.get(n, NO_PHRASE)[0]) is not None), v)
        for span, n in ((p3, 3), (p3, 2), (p2, 2)):
            v += span.get(n, NO_PHRASE)[1] or 0.0
        return v


SUMS = "struct<n: long, sum: double, pos: double, neg: double, npos: long, nneg: long>"
HITS = "array<struct<i: int, word: string, valence: double>>"


def sums_of(scorer: Scorer, texts: pa.Array) -> pa.Array:
    """Per text: words, sum of valences, sums and counts of positive (+1) and negative (-1) ones."""
    rows = []
    for text in texts.to_pylist():
        n, hits = scorer.hits(text or "")
        values = [v for _, _, v in hits]
        pos, neg = [v + 1 for v in values if v > 0], [v - 1 for v in values if v < 0]
        rows.append({"n": n, "sum": sum(values, 0.0), "pos": sum(pos, 0.0), "neg": sum(neg, 0.0), "npos": len(pos), "nneg": len(neg)})
    return pa.array(rows, pa.struct([("n", pa.int64()), ("sum", pa.float64()), ("pos", pa.float64()), ("neg", pa.float64()),
                                     ("npos", pa.int64()), ("nneg", pa.int64())]))


def hits_of(scorer: Scorer, texts: pa.Array) -> pa.Array:
    rows = [[{"i": i, "word": w, "valence": v} for i, w, v in scorer.hits(text or "")[1]] for text in texts.to_pylist()]
    return pa.array(rows, pa.list_(pa.struct([("i", pa.int32()), ("word", pa.string()), ("valence", pa.float64())])))
