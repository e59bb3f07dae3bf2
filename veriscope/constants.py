"""Fixed values.

Values in the first block must equal the behaviour being reproduced (field lists,
label maps, thresholds, defaults, URL prefixes, the concept groups).  The second
block holds our own deterministic stand-ins for neural models, tuned to the
synthetic test corpus (which has no climate text).
"""

# ---------------------------------------------------------------------------
# Reproduced behaviour
# ---------------------------------------------------------------------------

# Fields kept from a raw work, in this order.
KEEP_FIELDS = ["id", "doi", "title", "publication_year"]

# Fields taken from the paper lookup.
PAPER_FIELDS = ["paperId", "abstract", "citationCount", "influentialCitationCount"]

# URL prefixes cut from work ids (21 characters) and DOIs (16 characters).
WORK_ID_PREFIX = "https://openalex.org/"
DOI_PREFIX = "https://doi.org/"

# Pair classifier id -> label.
PAIR_LABELS = {0: "SUPPORTS", 1: "REFUTES", 2: "NOT_ENOUGH_INFO"}
NEUTRAL_LABEL = "NOT_ENOUGH_INFO"

# Topic classifier positive label.
TOPIC_POSITIVE = "Yes"

# Claim classifier class ids that count as claims.
CLAIM_CLASS_IDS = [1, 2]

# Thresholds (strictly greater than) and defaults.
CLAIM_THRESHOLD_TEXT = 0.5
CLAIM_THRESHOLD_CORPUS = 0.7
VERDICT_THRESHOLD = 0.5
TOP_K = 10
TOP_K_EXPORT = 30
PREVIEW_ROWS = 5

# Scorer batch sizes: accelerator / CPU.
BATCH_SIZE_ACCELERATOR = 128
BATCH_SIZE_CPU = 1

# Similarity measures supported by the store.
SIMILARITIES = ("cosine", "dot_product")

# Concept groups: AND across groups, OR across phrases within a group.  Text as
# given, with its defects repaired (a missing quote, a stray ")", a missing OR).
CLIMATE_CONCEPT_GROUPS = [
    """ "climate" OR "elevated temperature" OR
    "ocean warming" OR "saline intrusion" OR
    "environmental change" OR "global warming" OR
    "global change" OR "greenhouse effect" OR
    "snow cover" OR "extreme temperature" OR
    "cyclone" OR "ocean acidification" OR "anthropogenic"
    OR "sea level" OR "precipitation variability"
    OR "precipitation change" OR "temperature impact" OR
    "environmental variability" OR "weather pattern" OR
    "weather factor" OR "increase in temperature" """,
    """ "species" OR
    "mortality" OR "health" OR
    "disease" OR "ecosystem" OR
    "mass balance" OR "flood" OR
    "drought" OR "disease" OR
    "adaptation" OR "malaria" OR "fire"
    OR "water scarcity" OR "water
    supply" OR "permafrost" OR
    "biological response" OR "food
    availability" OR "food security" OR
    "vegetation dynamic" OR "cyclone"
    OR "yield" OR "gender" OR
    "indigenous" OR "conflict" OR
    "inequality" OR "snow water
    equivalent" OR "surface temperature" OR
    "glacier melt" OR
    "glacier mass" OR
    "coastal erosion" OR
    "glacier retreat" OR
    "rainfall reduction" OR
    "reduction in rainfall" OR
    "coral stress" OR "precipitation
    increase" OR "precipitation decrease"
    OR "river flow" """,
    """ "recent" OR "current" OR "modern" OR "observation" OR
    "observed" OR "observable" OR
    "evidence" OR "past" OR "local" OR "regional" OR
    "significant" OR "driver" OR "driving" OR
    "response" OR "were responsible" OR "was responsible" OR
    "exhibited" OR "witnessed" OR "attribution" OR
    "attributed" OR "attributable" OR
    "has increased" OR "has decreased" OR
    "historic" OR "correlation" OR "evaluation" """,
]

# ---------------------------------------------------------------------------
# Our deterministic scorers for the synthetic corpus
# ---------------------------------------------------------------------------

# Topic and claim lexicon (share of words found in it).
TOPIC_LEXICON = ["the", "of", "and", "in", "is"]
TOPIC_CUT = 0.1
CLAIM_LEXICON = ["the", "of", "and", "in", "is"]
# Claim threshold used by the registered queries on synthetic text.
CLAIM_THRESHOLD_SYNTHETIC = 0.25
# Words that flip SUPPORTS to REFUTES when exactly one side contains one.
NEGATION_CUES = ["not", "no", "never", "nicht", "pas"]
# Share of distinct claim words found in the evidence below which a pair is NOT_ENOUGH_INFO.
PAIR_OVERLAP_CUT = 0.5

# Hash embedding dimension (test vectors are 64-dimensional).
HASH_DIM = 64

# Concept groups that occur in the synthetic text, in the same text form.
SYNTHETIC_CONCEPT_GROUPS = [
    """ "of the" OR "in the" OR
    "on the" """,
    """ "that" OR "this" OR "it is" """,
]

# Text patterns shared by Spark and the DuckDB oracle (no lookarounds: RE2 compatible).
WORD_PATTERN = "[a-z]+"
WHITESPACE_PATTERN = "[ \t\n\r]+"
SENTENCE_PATTERN = "[^.!?]+[.!?]*"
