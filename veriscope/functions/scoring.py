"""Deterministic lexicon scorers as Column expressions (stand-ins for U1-U3 models).

Each returns ``struct<label, score>`` so a model-backed batch scorer with the same
output shape can replace it (see ``operators.models``)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from veriscope.constants import (
    NEGATION_CUES, PAIR_LABELS, PAIR_OVERLAP_CUT, TOPIC_CUT, TOPIC_LEXICON, TOPIC_POSITIVE,
    CLAIM_LEXICON,
)
from veriscope.functions.text import _c, words


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def lexicon_hits(text, lexicon) -> Column:
    """Number of words of ``text`` that are in ``lexicon``: one regex pass over the
    lower-cased text, a hit being a whole [a-z]+ run (lookarounds, JVM regex)."""
    alts = "|".join(re.escape(w) for w in sorted(lexicon, key=len, reverse=True))
    return F.size(F.regexp_extract_all(F.lower(_c(text)), F.lit(f"(?<![a-z])(?:{alts})(?![a-z])"), 0))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element ``transform``),
    so a costly expression used several times in a result is computed once."""
    return F.transform(F.array(value), body).getItem(0)


def lexicon_share(text, lexicon) -> Column:
    """hits / words; 0 for a text without words."""
    return let(F.struct(F.size(words(text)).alias("n"), lexicon_hits(text, lexicon).alias("h")),
               lambda c: F.when(c["n"] > 0, c["h"] / c["n"]).otherwise(F.lit(0.0)))


def topic_score(text, lexicon=TOPIC_LEXICON, cut: float = TOPIC_CUT) -> Column:
    """U1 stand-in: label 'Yes' when share >= cut; score = share if Yes else 1 - share."""
    def decide(share):
        yes = share >= F.lit(cut)
        return F.struct(F.when(yes, F.lit(TOPIC_POSITIVE)).otherwise(F.lit("No")).alias("label"),
                        F.round(F.when(yes, share).otherwise(1 - share), 6).alias("score"))
    return let(lexicon_share(text, lexicon), decide)


def claim_score(sentence, lexicon=CLAIM_LEXICON) -> Column:
    """U2 stand-in: class 1 when any lexicon word is present else 0; score = share."""
    def decide(c):
        share = F.when(c["n"] > 0, c["h"] / c["n"]).otherwise(F.lit(0.0))
        return F.struct(F.when(c["h"] > 0, F.lit(1)).otherwise(F.lit(0)).alias("label"),
                        F.round(share, 6).alias("score"))
    return let(F.struct(F.size(words(sentence)).alias("n"), lexicon_hits(sentence, lexicon).alias("h")), decide)


def pair_score(claim, evidence, cues=NEGATION_CUES, cut: float = PAIR_OVERLAP_CUT) -> Column:
    """U3 stand-in over (claim, evidence).

    o = share of distinct claim words found in the evidence; o < cut -> NOT_ENOUGH_INFO
    with prob 1 - o; otherwise REFUTES when exactly one side holds a cue word, else
    SUPPORTS, with prob o.  Word sets use hash-based array_intersect (O(n + m)).
    """
    cue = _lit_array(cues)

    def features(w):
        cw, ew = w["cw"], w["ew"]
        n = F.size(cw)
        o = F.when(n > 0, F.size(F.array_intersect(cw, ew)) / n).otherwise(F.lit(0.0))
        return F.struct(o.alias("o"), F.arrays_overlap(cw, cue).alias("cn"), F.arrays_overlap(ew, cue).alias("en"))

    def decide(f):
        o, c_neg, e_neg = f["o"], f["cn"], f["en"]
        flip = (c_neg & ~e_neg) | (~c_neg & e_neg)
        label = (F.when(o < F.lit(cut), F.lit(PAIR_LABELS[2]))
                 .when(flip, F.lit(PAIR_LABELS[1]))
                 .otherwise(F.lit(PAIR_LABELS[0])))
        prob = F.when(o < F.lit(cut), 1 - o).otherwise(o)
        return F.struct(label.alias("label"), F.round(prob, 6).alias("prob"))

    word_sets = F.struct(F.array_distinct(words(claim)).alias("cw"), words(evidence).alias("ew"))
    return let(let(word_sets, features), decide)
