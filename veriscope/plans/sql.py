"""SQL fragments mirroring the Spark column functions, for the DuckDB oracles."""

from veriscope.constants import (
    CLAIM_LEXICON, DOI_PREFIX, HASH_DIM, NEGATION_CUES, PAIR_OVERLAP_CUT, TOPIC_CUT, TOPIC_LEXICON,
    WORK_ID_PREFIX,
)

WS = r"[ \t\n\r]+"


def lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z]+')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def sentences(x: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all(regexp_replace({x}, '{WS}', ' ', 'g'), "
            f"'[^.!?]+[.!?]*'), lambda s: trim(s)), lambda s: s <> '')")


def buckets(x: str, dim: int = HASH_DIM) -> str:
    return f"list_transform({words(x)}, lambda w: ((('0x' || substr(md5(w), 1, 8))::UBIGINT) % {dim})::INTEGER)"


def dense(bk: str, dim: int = HASH_DIM) -> str:
    return f"list_transform(range({dim}), lambda i: len(list_filter({bk}, lambda b: b = i))::DOUBLE)"


def vec_string(v: str) -> str:
    return f"array_to_string(list_transform({v}, lambda x: x::BIGINT::VARCHAR), ',')"


def share(x: str, lexicon) -> str:
    ws = words(x)
    return (f"(CASE WHEN len({ws}) > 0 THEN len(list_filter({ws}, lambda w: list_contains({lst(lexicon)}, w)))"
            f" / len({ws}) ELSE 0.0 END)")


def topic_yes(x: str) -> str:
    return f"({share(x, TOPIC_LEXICON)} >= {TOPIC_CUT})"


def claim_label(x: str) -> str:
    ws = words(x)
    return f"(CASE WHEN len(list_filter({ws}, lambda w: list_contains({lst(CLAIM_LEXICON)}, w))) > 0 THEN 1 ELSE 0 END)"


def claim_score(x: str) -> str:
    return f"round({share(x, CLAIM_LEXICON)}, 6)"


def cosine(a: str, b: str) -> str:
    return (f"(CASE WHEN list_dot_product({a}, {a}) * list_dot_product({b}, {b}) > 0 THEN "
            f"list_dot_product({a}, {b}) / sqrt(list_dot_product({a}, {a}) * list_dot_product({b}, {b})) "
            f"ELSE 0.0 END)")


def pair(claim: str, evidence: str) -> tuple[str, str]:
    cw = f"list_distinct({words(claim)})"
    ew = words(evidence)
    o = f"(CASE WHEN len({cw}) > 0 THEN len(list_intersect({cw}, {ew})) / len({cw}) ELSE 0.0 END)"
    cn = f"list_has_any({cw}, {lst(NEGATION_CUES)})"
    en = f"list_has_any({ew}, {lst(NEGATION_CUES)})"
    label = (f"(CASE WHEN {o} < {PAIR_OVERLAP_CUT} THEN 'NOT_ENOUGH_INFO' "
             f"WHEN ({cn} AND NOT {en}) OR (NOT {cn} AND {en}) THEN 'REFUTES' ELSE 'SUPPORTS' END)")
    prob = f"round(CASE WHEN {o} < {PAIR_OVERLAP_CUT} THEN 1 - {o} ELSE {o} END, 6)"
    return label, prob


# Work columns derived from a documents row aliased d.
WORK_ID = f"'{WORK_ID_PREFIX}W' || d.doc_id"
WORK_DOI = f"CASE WHEN d.lang <> 'es' THEN '{DOI_PREFIX}10.5555/' || d.doc_id END"
WORK_YEAR = "(2000 + (d.doc_id % 24))::INTEGER"

AUTHORS_CTE = ("authors_by_conv AS (SELECT conv_id, string_agg(role, ', ' ORDER BY turn) "
               "FILTER (WHERE role <> 'system') AS authors FROM conversations GROUP BY conv_id)")

STORE_CTE = ("store AS (SELECT * FROM documents d QUALIFY row_number() OVER "
             "(PARTITION BY sha256(coalesce(d.text, '')) ORDER BY d.doc_id) = 1)")


def store_vectors_cte(dim: int = HASH_DIM) -> str:
    return (f"sb AS (SELECT doc_id, text, source, lang, {buckets('concat_ws(chr(10), source, text)', dim)} AS bk "
            f"FROM store), sv AS (SELECT doc_id, text, source, lang, {dense('bk', dim)} AS v FROM sb)")
