"""Verdicts for (claim, evidence) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.constants import VERDICT_THRESHOLD
from veriscope.functions.scoring import pair_score
from veriscope.operators.filters import score_once, verdict_predicate


def classify_pairs(pairs: DataFrame, claim_col: str = "claim", evidence_col: str = "content",
                   scorer=None) -> DataFrame:
    """U3 over already-flat pair rows (J8 is the match table itself)."""
    scorer = scorer or pair_score
    return score_once(pairs, scorer(F.col(claim_col), F.col(evidence_col)), "_v").select(
        "*", F.col("_v.label").alias("label"), F.col("_v.prob").alias("prob")).drop("_v")


def verdicts(pairs: DataFrame, claim_col: str = "claim", evidence_col: str = "content",
             threshold: float = VERDICT_THRESHOLD, print_neutral: bool = False, scorer=None) -> DataFrame:
    """C8 tail: score pairs, keep those passing P14."""
    return classify_pairs(pairs, claim_col, evidence_col, scorer).filter(
        verdict_predicate("label", "prob", threshold, print_neutral))
