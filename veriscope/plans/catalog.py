"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their DuckDB oracles.

Every query reads the given tables whole (no id subsets, no row caps; a limit only where it is
the feature).  ``tree_search`` takes the stated query set of searches, vec_id % 100 = 0, against
all rows.  Column names and types match the oracle's.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriscope.constants import (
    CLAIM_THRESHOLD_SYNTHETIC, DOI_PREFIX, HASH_DIM, SYNTHETIC_CONCEPT_GROUPS, TOP_K, TOP_K_EXPORT,
    TOPIC_LEXICON, WORK_ID_PREFIX,
)
from veriscope.functions.text import (
    article_text, doc_key, embed_input, uninvert_abstract, words,
)
from veriscope.functions.vectors import hash_embedding
from veriscope.operators import bayes, concepts, knn, tree
from veriscope.operators.claims import (
    attach_claims, claim_documents, claims_per_doc, extract_claims, split_sentences,
)
from veriscope.operators.enrich import enrich_by_doi, normalize_works
from veriscope.operators.filters import (
    concept_filter, concept_regex, parse_concept_groups, resolve_input, search_by_field, topic_gate,
)
from veriscope.operators.models import apply_topic_model, fit_topic_model, partition_map
from veriscope.plans import jobs
from veriscope.plans import sql as S
from veriscope.plans.views import (
    document_rows, embedded_store, invert_text, load, papers_view, raw_works, store_documents, works_view,
)
from veriscope.schemas import CLAIM_RECORD, CORPUS_RECORD, WORK
from veriscope.session import scratch_path
from veriscope.sources.jsonl import write_claims_jsonl, write_corpus_jsonl
from veriscope.sources.manifest import BatchTable
from veriscope.sources.scan import spread, written
from veriscope.sources.store import EvidenceStore, dedupe_documents, embed_missing
from veriscope.sources.works import (
    corpus_profile, flatten_works, land_pages, land_works_csv, preview, read_checked_pages, read_works_csv,
    read_works_pages, rejected_pages, skip_done, write_works_csv,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORK_COLS = ["id", "doi", "title", "publication_year", "abstract", "authors"]
TOPK_PHRASE = "the evidence of the change in the sea level and the temperature"
IVF_CELLS = 8
IVF_PROBES = 9


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register


def vec_string(col: str):
    return F.array_join(F.transform(F.col(col), lambda x: x.cast("long").cast("string")), ",")


def joined(col: str, sep: str = " | "):
    return F.array_join(F.col(col), sep)


# ----------------------------------------------------------------------------- works

_INVERT_SQL = f"""
t AS (SELECT doc_id, string_split({S.collapse('text')}, ' ') AS ws FROM documents),
u AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM t),
fw AS (SELECT doc_id, w, min(p) AS p FROM u GROUP BY doc_id, w),
abs AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS abstract FROM fw GROUP BY doc_id)"""

_WORKS_SQL = f"""
SELECT {S.WORK_ID} AS id, {S.WORK_DOI} AS doi, d.source AS title, {S.WORK_YEAR} AS publication_year,
       a.abstract, coalesce(au.authors, '') AS authors
FROM documents d JOIN abs a USING (doc_id) LEFT JOIN authors_by_conv au ON au.conv_id = d.doc_id"""


@query("uninvert_abstract", f"WITH {_INVERT_SQL} SELECT doc_id, abstract FROM abs")
def q_uninvert(spark, sf):
    inv = invert_text(load(spark, sf, "documents"))
    return inv.select("doc_id", uninvert_abstract(F.col("abstract_inverted_index")).alias("abstract"))


def _landed_pages(spark, sf) -> str:
    path = scratch_path(spark, "pages")
    raw_works(spark, sf).write.mode("overwrite").json(path)
    return path


@query("parse_works", f"WITH {_INVERT_SQL}, {S.AUTHORS_CTE} {_WORKS_SQL}")
def q_parse_works(spark, sf):
    return flatten_works(read_works_pages(spark, _landed_pages(spark, sf), multiline=False))


PAGE_WORKS = 50


def _landed_arrays(spark, sf) -> str:
    """Work pages as JSON arrays of 50 works, every fourth of them a second time cut off, a cursor file beside them."""
    path = scratch_path(spark, "array-pages")
    page = (F.regexp_extract("id", r"(\d+)$", 1).cast("long") / PAGE_WORKS).cast("long")
    land_pages(raw_works(spark, sf), path, page, page % 4 == 1)
    spark.createDataFrame([("cursor",)], "value string").coalesce(1).write.mode("append").text(f"{path}/next_cursor")
    return path


@query("parse_pages_array", f"WITH {_INVERT_SQL}, {S.AUTHORS_CTE} {_WORKS_SQL}")
def q_parse_pages_array(spark, sf):
    return flatten_works(read_checked_pages(spark, _landed_arrays(spark, sf)))


@query("rejected_pages", f"""
SELECT 'results_' || page || '_cut.json' AS file_name, 1::BIGINT AS n_bad
FROM (SELECT DISTINCT doc_id // {PAGE_WORKS} AS page FROM documents) WHERE page % 4 = 1""")
def q_rejected_pages(spark, sf):
    return rejected_pages(spark, _landed_arrays(spark, sf)).select("file_name", "n_bad")


@query("corpus_profile", f"WITH {_INVERT_SQL}, {S.AUTHORS_CTE} "
       f"SELECT count(*) AS n_rows, 6::INTEGER AS n_cols FROM ({_WORKS_SQL})")
def q_corpus_profile(spark, sf):
    return corpus_profile(q_parse_works(spark, sf))


@query("works_preview", f"WITH {_INVERT_SQL}, {S.AUTHORS_CTE} SELECT * FROM ({_WORKS_SQL}) "
       "ORDER BY publication_year, id LIMIT 5")
def q_preview(spark, sf):
    return preview(q_parse_works(spark, sf), ["publication_year", "id"], 5)


_GROUPS = parse_concept_groups(SYNTHETIC_CONCEPT_GROUPS)


def _sql_concept(x: str) -> str:
    return " AND ".join(f"regexp_matches(lower({x}), '{concept_regex(g)}')" for g in _GROUPS)


@query("build_corpus", f"WITH {_INVERT_SQL}, {S.AUTHORS_CTE}, w AS ({_WORKS_SQL}) "
       f"SELECT id, 'title' AS matched_field FROM w WHERE {_sql_concept('title')} "
       f"UNION ALL SELECT id, 'abstract' AS matched_field FROM w WHERE {_sql_concept('abstract')}")
def q_build_corpus(spark, sf):
    pages = _landed_pages(spark, sf)
    out = scratch_path(spark, "corpus")
    jobs.build_corpus(spark, pages, SYNTHETIC_CONCEPT_GROUPS, out=out, multiline=False)
    return spark.read.parquet(out).select("id", F.col("field").alias("matched_field"))


@query("works_csv_roundtrip", f"""
WITH {S.AUTHORS_CTE}
SELECT {S.WORK_ID} AS id, coalesce({S.WORK_DOI}, '') AS doi, coalesce(d.source, '') AS title,
       {S.WORK_YEAR} AS publication_year, coalesce(d.text, '') AS abstract, coalesce(au.authors, '') AS authors
FROM documents d LEFT JOIN authors_by_conv au ON au.conv_id = d.doc_id""")
def q_csv_roundtrip(spark, sf):
    from veriscope.operators.filters import fill_missing
    path = scratch_path(spark, "works-csv")
    write_works_csv(works_view(spark, sf).select(*WORK_COLS), path)
    return fill_missing(read_works_csv(spark, path))


@query("skip_done", "SELECT d.doc_id FROM documents d WHERE NOT EXISTS "
       "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q_skip_done(spark, sf):
    return skip_done(load(spark, sf, "documents").select(F.col("doc_id").alias("id")),
                     load(spark, sf, "labels").select(F.col("doc_id").alias("id")), "id") \
        .select(F.col("id").alias("doc_id"))


# ----------------------------------------------------------------------------- filters

@query("concept_filter", f"SELECT doc_id FROM documents WHERE {_sql_concept('text')}")
def q_concept_filter(spark, sf):
    return concept_filter(load(spark, sf, "documents"), "text", SYNTHETIC_CONCEPT_GROUPS).select("doc_id")


def _sql_article_text(h: str) -> str:
    art = f"regexp_extract({h}, '(?s)<article[^>]*>(.*)</article>', 1)"
    body = f"regexp_extract({h}, '(?s)<body[^>]*>(.*)</body>', 1)"
    m = f"coalesce(nullif({art}, ''), nullif({body}, ''), {h})"
    for pat in ["(?s)<!--.*?-->", "(?s)<script[^>]*>.*?</script>", "(?s)<style[^>]*>.*?</style>",
                "(?s)<nav[^>]*>.*?</nav>", "(?s)<footer[^>]*>.*?</footer>"]:
        m = f"regexp_replace({m}, '{pat}', ' ', 'g')"
    m = f"regexp_replace({m}, '<[^>]*>', ' ', 'g')"
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
                    ("&amp;", "&")]:
        m = f"replace({m}, '{ent}', '{ch}')"
    return S.collapse(m)


_TITLE_RE = "(?s)<title[^>]*>(.*?)</title>"


@query("article_text", f"SELECT page_id, {_sql_article_text('html')} AS text FROM pages")
def q_article_text(spark, sf):
    return load(spark, sf, "pages").select("page_id", article_text(F.col("html")).alias("text"))


@query("search_by_field", f"""
WITH p AS (SELECT page_id, regexp_extract(html, '{_TITLE_RE}', 1) AS title, {_sql_article_text('html')} AS abstract
           FROM pages)
SELECT page_id, 'title' AS matched_field FROM p WHERE {_sql_concept('title')}
UNION ALL SELECT page_id, 'abstract' AS matched_field FROM p WHERE {_sql_concept('abstract')}""")
def q_search_by_field(spark, sf):
    pages = load(spark, sf, "pages").select(
        "page_id", F.regexp_extract("html", _TITLE_RE, 1).alias("title"),
        article_text(F.col("html")).alias("abstract"))
    return search_by_field(pages, ["title", "abstract"], SYNTHETIC_CONCEPT_GROUPS).select("page_id", "matched_field")


@query("resolve_input", f"""
WITH pg AS (SELECT url, arg_min(html, page_id) AS html FROM pages GROUP BY url),
inp AS (SELECT 'conversation' AS source, conv_id AS source_id, turn, text FROM conversations
        UNION ALL SELECT 'page', page_id, 0, url FROM pages)
SELECT i.source, i.source_id, i.turn,
       CASE WHEN coalesce(starts_with(i.text, 'http'), false) THEN {_sql_article_text('pg.html')} ELSE i.text END
       AS resolved
FROM inp i LEFT JOIN pg ON coalesce(starts_with(i.text, 'http'), false) AND pg.url = i.text""")
def q_resolve_input(spark, sf):
    pages = load(spark, sf, "pages")
    inputs = (load(spark, sf, "conversations")
              .select(F.lit("conversation").alias("source"), F.col("conv_id").alias("source_id"), "turn", "text")
              .unionByName(pages.select(F.lit("page").alias("source"), F.col("page_id").alias("source_id"),
                                        F.lit(0).cast("long").alias("turn"), F.col("url").alias("text"))))
    one_page = pages.groupBy("url").agg(F.min(F.struct("page_id", "html")).alias("p")).select("url", "p.html")
    return resolve_input(inputs, one_page).select("source", "source_id", "turn", "resolved")


_NORM_SQL = f"""
nw AS (SELECT regexp_replace({S.WORK_ID}, '^{re.escape(WORK_ID_PREFIX)}', '') AS openalex_id,
              regexp_replace({S.WORK_DOI}, '^{re.escape(DOI_PREFIX)}', '') AS doi,
              coalesce(d.source, '') AS title, {S.WORK_YEAR} AS year, coalesce(d.text, '') AS abstract
       FROM documents d WHERE {S.WORK_DOI} IS NOT NULL)"""


@query("normalize_ids", f"WITH {_NORM_SQL} SELECT * FROM nw")
def q_normalize(spark, sf):
    return normalize_works(works_view(spark, sf).select(*WORK_COLS))


_PAPERS_SQL = """
pp AS (SELECT '10.5555/' || doc_id AS doi, 'P' || doc_id AS paperId,
              CASE WHEN quality = 1 THEN 'enriched abstract of work ' || doc_id ELSE '' END AS abstract,
              (quality * 10 + toxic)::INTEGER AS citationCount, toxic::INTEGER AS influentialCitationCount
       FROM labels),
pu AS (SELECT * FROM pp QUALIFY row_number() OVER (PARTITION BY doi
       ORDER BY paperId, abstract, citationCount, influentialCitationCount) = 1)"""

_ENRICH_SQL = f"""
WITH {_NORM_SQL}, {_PAPERS_SQL}
SELECT nw.openalex_id, nw.doi, nw.title, nw.year, coalesce(pu.paperId, '') AS paperId,
       pu.citationCount, pu.influentialCitationCount,
       coalesce(nullif(pu.abstract, ''), nw.abstract) AS abstract
FROM nw LEFT JOIN pu USING (doi)"""


@query("enrich_by_doi", _ENRICH_SQL)
def q_enrich(spark, sf):
    return enrich_by_doi(normalize_works(works_view(spark, sf).select(*WORK_COLS)), papers_view(spark, sf))


@query("enrich_corpus", _ENRICH_SQL)
def q_enrich_corpus(spark, sf):
    src = scratch_path(spark, "enrich-in")
    write_works_csv(works_view(spark, sf).select(*WORK_COLS), src)
    out = scratch_path(spark, "enriched")
    jobs.enrich_corpus(spark, src, papers_view(spark, sf), out=out)
    return spark.read.parquet(out)


@query("enrich_resume", _ENRICH_SQL)
def q_enrich_resume(spark, sf):
    """A run killed after staging a batch, one ended after two parts, one to the end, one more: every work once."""
    src = scratch_path(spark, "enrich-in")
    write_works_csv(works_view(spark, sf).select(*WORK_COLS), src)
    papers = written(papers_view(spark, sf), "papers")
    landed = BatchTable(spark, scratch_path(spark, "landed"), f"{WORK.simpleString()[7:-1].replace(':', ' ')}, part int")
    out = BatchTable(spark, scratch_path(spark, "enriched"), jobs.ENRICHED)
    works = land_works_csv(read_works_csv(spark, src), landed, 4)
    out.stage(enrich_by_doi(normalize_works(works.drop("part")), papers), "works/00000")      # killed before its commit
    jobs.enrich_resumable(spark, src, papers, landed, out, parts=4, limit=2)
    jobs.enrich_resumable(spark, src, papers, landed, out, parts=4)
    jobs.enrich_resumable(spark, src, papers, landed, out, parts=4)
    return out.read()


# ----------------------------------------------------------------------------- sentences / claims

_SENT_CTE = f"""
ss AS (SELECT doc_id, {S.sentences('text')} AS l FROM documents),
sent AS (SELECT doc_id, (generate_subscripts(l, 1) - 1)::INTEGER AS pos, unnest(l) AS sentence FROM ss)"""

_CLAIMS_CTE = f"""{_SENT_CTE},
cl AS (SELECT doc_id, pos, sentence, {S.claim_score('sentence')} AS score FROM sent
       WHERE {S.claim_label('sentence')} IN (1, 2) AND {S.claim_score('sentence')} > {CLAIM_THRESHOLD_SYNTHETIC})"""


@query("split_sentences", f"WITH {_SENT_CTE} SELECT doc_id, pos, sentence FROM sent")
def q_split_sentences(spark, sf):
    return split_sentences(load(spark, sf, "documents"), "text", ["doc_id"])


@query("topic_gate", f"SELECT doc_id, 'Yes' AS label, round({S.share('text', TOPIC_LEXICON)}, 6) AS score "
       f"FROM documents WHERE {S.topic_yes('text')}")
def q_topic_gate(spark, sf):
    g = topic_gate(load(spark, sf, "documents"), "text")
    return g.select("doc_id", F.col("topic.label").alias("label"), F.col("topic.score").alias("score"))


@query("extract_claims", f"WITH {_CLAIMS_CTE} SELECT doc_id, pos, sentence, score FROM cl")
def q_extract_claims(spark, sf):
    c = extract_claims(load(spark, sf, "documents"), "text", ["doc_id"], CLAIM_THRESHOLD_SYNTHETIC)
    return c.select("doc_id", "pos", "sentence", "score")


@query("claims_per_doc", f"WITH {_CLAIMS_CTE} SELECT doc_id, string_agg(sentence, ' | ' ORDER BY pos) AS claims, "
       "count(*) AS n_claims FROM cl GROUP BY doc_id")
def q_claims_per_doc(spark, sf):
    c = extract_claims(load(spark, sf, "documents"), "text", ["doc_id"], CLAIM_THRESHOLD_SYNTHETIC)
    g = claims_per_doc(c, "doc_id")
    return g.select("doc_id", joined("claims").alias("claims"), F.size("claims").cast("long").alias("n_claims"))


@query("claim_documents", f"""
WITH {S.AUTHORS_CTE}, {_CLAIMS_CTE}
SELECT {S.WORK_ID} AS open_alex_id, row_number() OVER (PARTITION BY cl.doc_id ORDER BY cl.pos)::INTEGER - 1 AS claim_pos,
       cl.sentence AS content, d.source AS title, {S.WORK_YEAR} AS publication_year,
       coalesce(au.authors, '') AS authors, {S.WORK_DOI} AS doi
FROM cl JOIN documents d USING (doc_id) LEFT JOIN authors_by_conv au ON au.conv_id = d.doc_id""")
def q_claim_documents(spark, sf):
    works = works_view(spark, sf).select(*WORK_COLS)
    claims = claims_per_doc(extract_claims(works, "abstract", ["id"], CLAIM_THRESHOLD_SYNTHETIC), "id")
    docs = claim_documents(attach_claims(works, claims, "id"))
    return docs.select(F.col("meta.open_alex_id").alias("open_alex_id"), "claim_pos", "content",
                       "meta.title", "meta.publication_year", "meta.authors", "meta.doi")


# ----------------------------------------------------------------------------- store

@query("dedupe_documents", "SELECT sha256(coalesce(text, '')) AS doc_key, min(doc_id) AS doc_id "
       "FROM documents GROUP BY 1")
def q_dedupe(spark, sf):
    d = load(spark, sf, "documents")
    return dedupe_documents(d.select(doc_key(F.col("text")).alias("doc_key"), "doc_id"))


@query("insert_if_absent", """
WITH n AS (SELECT sha256(coalesce(text, '')) AS doc_key, min(doc_id) AS doc_id FROM documents GROUP BY 1),
e AS (SELECT DISTINCT sha256(coalesce(text, '')) AS doc_key FROM documents WHERE lang = 'en')
SELECT n.doc_key, n.doc_id FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.doc_key = n.doc_key)""")
def q_insert_if_absent(spark, sf):
    from veriscope.sources.store import insert_if_absent
    d = load(spark, sf, "documents").select(doc_key(F.col("text")).alias("doc_key"), "doc_id", "lang")
    existing = dedupe_documents(d.filter(F.col("lang") == "en").drop("lang"))
    return insert_if_absent(dedupe_documents(d.drop("lang")), existing).select("doc_key", "doc_id")


_EMB_SQL = f"""
SELECT doc_id, {S.vec_string(S.dense(S.buckets('concat_ws(chr(10), source, text)')))} AS vec FROM documents"""


@query("hash_embedding", _EMB_SQL)
def q_hash_embedding(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", hash_embedding(embed_input(F.col("source"), F.col("text"))).alias("v")) \
        .select("doc_id", vec_string("v").alias("vec"))


@query("embed_missing", f"""
SELECT doc_id, CASE WHEN lang = 'en' THEN array_to_string(list_transform(range({HASH_DIM}), lambda i: '0'), ',')
       ELSE {S.vec_string(S.dense(S.buckets('concat_ws(chr(10), source, text)')))} END AS vec FROM documents""")
def q_embed_missing(spark, sf):
    d = load(spark, sf, "documents")
    stored = d.withColumn("embedding", F.when(F.col("lang") == "en", F.array_repeat(F.lit(0.0).cast("float"),
                                                                                     HASH_DIM)))
    filled = embed_missing(stored, hash_embedding, embed_input(F.col("source"), F.col("text")))
    return filled.select("doc_id", vec_string("embedding").alias("vec"))


@query("embedding_count", f"WITH {S.STORE_CTE} SELECT count(*) AS n_docs, "
       "count(*) FILTER (WHERE lang = 'en') AS n_embeddings FROM store")
def q_embedding_count(spark, sf):
    path = scratch_path(spark, "store")
    store = EvidenceStore(spark, path, recreate=True)
    docs = store_documents(spark, sf)
    lang = load(spark, sf, "documents").select("doc_id", "lang")
    with_lang = docs.join(lang, "doc_id")
    # Documents stored earlier without vectors (non-English) keep a null embedding.
    rows = with_lang.select("doc_key", "doc_id", "content", "meta",
                            F.when(F.col("lang") == "en",
                                   hash_embedding(embed_input(F.col("meta.title"), F.col("content"))))
                            .alias("embedding"))
    rows.write.mode("append").parquet(path)
    s = store.read()
    return s.agg(F.count(F.lit(1)).alias("n_docs"), F.count("embedding").alias("n_embeddings"))


@query("index_abstracts", f"""
SELECT sha256(coalesce(text, '')) AS doc_key, min(doc_id) AS doc_id, arg_min(source, doc_id) AS title
FROM documents WHERE {S.topic_yes('text')} GROUP BY 1""")
def q_index_abstracts(spark, sf):
    store = EvidenceStore(spark, scratch_path(spark, "abstracts"), recreate=True)
    jobs.index_abstracts(works_view(spark, sf), store, gate=True, keep=["doc_id"])
    return store.read().select("doc_key", "doc_id", F.col("meta.title").alias("title"))


@query("index_claims", f"""
WITH {_CLAIMS_CTE}
SELECT DISTINCT sha256(sentence) AS doc_key, sentence AS content FROM cl WHERE {S.topic_yes('sentence')}""")
def q_index_claims(spark, sf):
    store = EvidenceStore(spark, scratch_path(spark, "claims"), recreate=True)
    jobs.index_claims(works_view(spark, sf).select(*WORK_COLS), store, CLAIM_THRESHOLD_SYNTHETIC, gate=True)
    return store.read().select("doc_key", "content")


# ----------------------------------------------------------------------------- k-NN on vectors

def _topk_sql(metric: str, queries: str = "embedding IS NOT NULL") -> str:
    score = "list_dot_product(q.v, s.v)" if metric == "dot_product" else S.cosine("q.v", "s.v")
    return f"""
WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings WHERE {queries}),
s AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
p AS (SELECT q.query_id, s.vec_id, round({score}, 6) AS score FROM q, s)
SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, score
FROM p QUALIFY rank <= {TOP_K}"""


def _vectors(spark, sf):
    """Every vector as a query against every vector."""
    e = load(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("query_id"), "embedding"), e


@query("topk_dot", _topk_sql("dot_product"))
def q_topk_dot(spark, sf):
    q, s = _vectors(spark, sf)
    return knn.knn_topk(q, s, TOP_K, "dot_product", qid="query_id", did="vec_id").select(
        "query_id", "vec_id", "rank", "score")


@query("topk_cosine", _topk_sql("cosine"))
def q_topk_cosine(spark, sf):
    q, s = _vectors(spark, sf)
    return knn.knn_topk(q, s, TOP_K, "cosine", qid="query_id", did="vec_id").select(
        "query_id", "vec_id", "rank", "score")


@query("topk_cosine_blocked", _topk_sql("cosine"))
def q_topk_cosine_blocked(spark, sf):
    """Same result through the blocked (cogroup) plan used when queries exceed the broadcast budget."""
    q, s = _vectors(spark, sf)
    return knn.knn_topk(q, s, TOP_K, "cosine", qid="query_id", did="vec_id", method="blocked",
                        max_store_rows=256).select("query_id", "vec_id", "rank", "score")


def _label_means(vectors):
    """One centre per label: the mean vector, to 6 decimals (one row per label)."""
    at = vectors.where("label is not null").select("label", F.posexplode("embedding").alias("i", "x"))
    means = at.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    rows = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("c")).orderBy("label").collect()
    return [[p["x"] for p in r["c"]] for r in rows]


def _ivf(spark, sf, nprobe: int, centres=None):
    q, s = _vectors(spark, sf)
    path = scratch_path(spark, "ivf-store")
    knn.build_ivf_index(s, path, "IVF_FLAT", IVF_CELLS, centroids=_label_means(s) if centres else None)
    store, centroids = knn.open_ivf_index(spark, path)
    probes = knn.probe_cells(q, centroids, nprobe)
    return knn.knn_topk(probes, store, TOP_K, "cosine", qid="query_id", did="vec_id",
                        probes="cells", cell="cell").select("query_id", "vec_id", "rank", "score")


@query("ivf_full_probe", _topk_sql("cosine"))
def q_ivf_full(spark, sf):
    return _ivf(spark, sf, IVF_CELLS)


_IVF_PROBE_SQL = f"""
WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
           WHERE label IS NOT NULL),
c AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, round(avg(x), 6) AS x FROM x GROUP BY ALL) GROUP BY label),
cells AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cell, c FROM c),
e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL),
near AS (SELECT e.*, cell, row_number() OVER (PARTITION BY vec_id ORDER BY
         list_dot_product(c, c) - 2 * list_dot_product(v, c) / sqrt(list_dot_product(v, v)), cell) AS nth FROM e, cells),
p AS (SELECT q.vec_id AS query_id, s.vec_id, round({S.cosine("q.v", "s.v")}, 6) AS score
      FROM near q JOIN near s ON q.cell = s.cell AND q.nth <= {IVF_PROBES} AND s.nth = 1)
SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, score
FROM p QUALIFY rank <= {TOP_K}"""


@query("ivf_probe", _IVF_PROBE_SQL)
def q_ivf_probe(spark, sf):
    """The nearest cells only, around given centres (the labels' mean vectors): 9 of them find 0.9 of the
    exact neighbours of vec_id % 100 = 0 and more on all given tables."""
    return _ivf(spark, sf, IVF_PROBES, centres=True)


def _all_topk(spark, sf, metric: str, **kw):
    q, s = _vectors(spark, sf)
    return knn.knn_topk(q, s, TOP_K, metric, qid="query_id", did="vec_id", **kw).select(
        "query_id", "vec_id", "rank", "score")


@query("topk_dot_all", _topk_sql("dot_product"))
def q_topk_dot_all(spark, sf):
    return _all_topk(spark, sf, "dot_product")


@query("topk_cosine_all", _topk_sql("cosine"))
def q_topk_cosine_all(spark, sf):
    return _all_topk(spark, sf, "cosine")


@query("topk_cosine_blocked_all", _topk_sql("cosine"))
def q_topk_cosine_blocked_all(spark, sf):
    return _all_topk(spark, sf, "cosine", method="blocked")


def _tree_search(spark, sf, metric: str, queries: str = "true"):
    q, s = _vectors(spark, sf)
    path = tree.build_tree(s, scratch_path(spark, "tree"), did="vec_id", metric=metric)
    return tree.search(q.where(queries), spark, path, TOP_K, metric, qid="query_id", did="vec_id").select(
        "query_id", "vec_id", "rank", "score")


@query("topk_exact_pruned", _topk_sql("cosine"))
def q_topk_exact_pruned(spark, sf):
    """Every vector against every vector through the tree's bounds and codes."""
    return _tree_search(spark, sf, "cosine")


@query("topk_exact_pruned_dot", _topk_sql("dot_product"))
def q_topk_exact_pruned_dot(spark, sf):
    return _tree_search(spark, sf, "dot_product")


@query("tree_search", _topk_sql("cosine", "vec_id % 100 = 0 AND embedding IS NOT NULL"))
def q_tree_search(spark, sf):
    """The stated query set of a search (vec_id % 100 = 0) against all rows, through a reopened tree."""
    return _tree_search(spark, sf, "cosine", "query_id % 100 = 0")


def _opened(spark, store, nlist: int, centres=None):
    """The store filed by IVF cells and opened again: (store, centres)."""
    path = scratch_path(spark, "ivf-store")
    knn.build_ivf_index(store, path, "IVF_FLAT", nlist, centroids=centres)
    return knn.open_ivf_index(spark, path)


def _probed(q, store, centroids, nprobe: int):
    return knn.knn_topk(knn.probe_cells(q, centroids, nprobe), store, TOP_K, "cosine", qid="query_id", did="vec_id",
                        probes="cells", cell="cell").select("query_id", "vec_id", "rank", "score")


@query("ivf_full_probe_all", _topk_sql("cosine"))
def q_ivf_full_all(spark, sf):
    q, s = _vectors(spark, sf)
    store, centroids = _opened(spark, s, IVF_CELLS)
    return _probed(q, store, centroids, len(centroids))


_IVF_RECALL_SQL = f"""
WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
           WHERE label IS NOT NULL),
c AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, round(avg(x), 6) AS x FROM x GROUP BY ALL) GROUP BY label),
cells AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cell, c FROM c),
e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL),
near AS (SELECT e.*, cell, row_number() OVER (PARTITION BY vec_id ORDER BY
         list_dot_product(c, c) - 2 * list_dot_product(v, c) / sqrt(list_dot_product(v, v)), cell) AS nth FROM e, cells),
home AS (SELECT vec_id, cell, v FROM near WHERE nth = 1),
pairs AS (SELECT q.vec_id AS query_id, s.vec_id, s.cell, round({S.cosine("q.v", "s.v")}, 6) AS score FROM e q, home s),
exact AS (SELECT query_id, vec_id, cell FROM pairs WHERE query_id % 100 = 0
          QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {TOP_K}),
hit AS (SELECT near.nth FROM exact JOIN near ON near.vec_id = exact.query_id AND near.cell = exact.cell),
enough AS (SELECT coalesce((SELECT min(n) FROM (SELECT DISTINCT nth AS n FROM near) t WHERE
           (SELECT count(*) FROM hit WHERE nth <= n) >= {knn.RECALL} * (SELECT count(*) FROM hit)
           AND (SELECT count(*) FROM hit) > 0), (SELECT count(*) FROM cells)) AS nprobe)
SELECT p.query_id, p.vec_id, row_number() OVER (PARTITION BY p.query_id ORDER BY p.score DESC, p.vec_id)::INTEGER AS rank, p.score
FROM pairs p JOIN near q ON q.vec_id = p.query_id AND q.cell = p.cell, enough WHERE q.nth <= enough.nprobe
QUALIFY rank <= {TOP_K}"""


@query("ivf_probe_recall", _IVF_RECALL_SQL)
def q_ivf_probe_recall(spark, sf):
    """Cells around the labels' mean vectors, as many probed as the recall measured on vec_id % 100 = 0 asks for."""
    q, s = _vectors(spark, sf)
    store, centroids = _opened(spark, s, 0, _label_means(s))
    nprobe = knn.choose_nprobe(q.where("query_id % 100 = 0"), store, centroids, TOP_K, qid="query_id", did="vec_id")
    return _probed(q, store, centroids, nprobe)


# ----------------------------------------------------------------------------- evidence pipeline

def _store_cte() -> str:
    return f"{S.STORE_CTE}, {S.store_vectors_cte()}"


def _article_claims_sql(table: str, id_cols: list[str], gate: bool) -> str:
    ids = ", ".join(id_cols)
    where = f"WHERE {S.topic_yes('text')}" if gate else ""
    return f"""
art AS (SELECT {ids}, text FROM {table} {where}),
asl AS (SELECT {ids}, {S.sentences('text')} AS l FROM art),
asent AS (SELECT {ids}, (generate_subscripts(l, 1) - 1)::INTEGER AS pos, unnest(l) AS claim FROM asl),
acl AS (SELECT * FROM asent WHERE {S.claim_label('claim')} IN (1, 2)
        AND {S.claim_score('claim')} > {CLAIM_THRESHOLD_SYNTHETIC}),
claims AS (SELECT *, row_number() OVER (ORDER BY {ids}, pos) - 1 AS claim_id FROM acl),
qv AS (SELECT claim_id, {S.dense(S.buckets('claim'))} AS v FROM claims)"""


def _matches_sql(k: int) -> str:
    return f"""
pairs AS (SELECT qv.claim_id, sv.doc_id, round({S.cosine('qv.v', 'sv.v')}, 6) AS score FROM qv, sv),
top AS (SELECT claim_id, doc_id, score,
               row_number() OVER (PARTITION BY claim_id ORDER BY score DESC, doc_id)::INTEGER AS rank
        FROM pairs QUALIFY rank <= {k}),
m AS (SELECT top.*, claims.claim, store.text AS content, store.source AS title,
             {S.WORK_DOI.replace('d.', 'store.')} AS doi, {S.WORK_YEAR.replace('d.', 'store.')} AS year
      FROM top JOIN claims USING (claim_id) JOIN store USING (doc_id))"""


def _benchmark_claims(spark, sf, gate: bool = True):
    articles = load(spark, sf, "benchmark")
    return jobs.article_claims(articles, ["item_id"], "text", CLAIM_THRESHOLD_SYNTHETIC, gate=gate)


def _benchmark_matches(spark, sf, k: int = TOP_K, gate: bool = True):
    return jobs.find_evidence(_benchmark_claims(spark, sf, gate), embedded_store(spark, sf), k)


_REPORT_SQL = f"""
WITH {_store_cte()}, {_article_claims_sql('benchmark', ['item_id'], True)}, {_matches_sql(TOP_K)}
SELECT claim_id, claim, rank, rank - 1 AS evidence_no, score, printf('%.3f', score) AS similarity, doc_id,
       content AS quote, title, doi, year FROM m"""


@query("match_report", _REPORT_SQL)
def q_match_report(spark, sf):
    return jobs.match_report(_benchmark_matches(spark, sf))


_DOT_MATCHES_SQL = _matches_sql(TOP_K).replace(S.cosine("qv.v", "sv.v"), "list_dot_product(qv.v, sv.v)")


@query("match_report_dot", f"""
WITH {_store_cte()}, {_article_claims_sql('benchmark', ['item_id'], True)}, {_DOT_MATCHES_SQL}
SELECT claim_id, claim, rank, rank - 1 AS evidence_no, score, printf('%.3f', score) AS similarity, doc_id,
       content AS quote, title, doi, year FROM m""")
def q_match_report_dot(spark, sf):
    """C11 by inner product: similarities beyond 1,000, without thousands separators."""
    return jobs.match_report(jobs.find_evidence(_benchmark_claims(spark, sf), embedded_store(spark, sf), TOP_K, metric="dot_product"))


@query("find_evidence", f"""
WITH {_store_cte()}, {_article_claims_sql('conversations', ['conv_id', 'turn'], True)}, {_matches_sql(TOP_K)}
SELECT m.claim_id, c.conv_id, c.turn, c.pos, m.rank, m.doc_id, m.score FROM m JOIN claims c USING (claim_id)""")
def q_find_evidence(spark, sf):
    articles = resolve_input(load(spark, sf, "conversations"), load(spark, sf, "pages"), out="text_resolved")
    articles = articles.select("conv_id", "turn", F.col("text_resolved").alias("text"))
    claims = jobs.article_claims(articles, ["conv_id", "turn"], "text", CLAIM_THRESHOLD_SYNTHETIC)
    m = jobs.find_evidence(claims, embedded_store(spark, sf), TOP_K)
    return (m.join(claims.select("claim_id", "conv_id", "turn", "pos"), "claim_id")
            .select("claim_id", "conv_id", "turn", "pos", "rank", "doc_id", "score"))


def _indexed_store(spark, sf):
    """The documents' store filed by IVF cells and opened again: (store, centres)."""
    path = scratch_path(spark, "ivf-documents")
    knn.build_ivf_index(embedded_store(spark, sf), path, "IVF_FLAT", IVF_CELLS)
    return knn.open_ivf_index(spark, path)


@query("match_report_ivf", _REPORT_SQL)
def q_match_report_ivf(spark, sf):
    """C11 through a reopened index; all cells probed, so it equals the exact report."""
    store, centroids = _indexed_store(spark, sf)
    return jobs.match_report(jobs.find_evidence(_benchmark_claims(spark, sf), store, TOP_K, centroids=centroids,
                                                nprobe=len(centroids)))


@query("store_top_k_batch", f"""
WITH {_store_cte()}, {_article_claims_sql('benchmark', ['item_id'], True)}, {_matches_sql(TOP_K)}
SELECT claim_id, doc_id, rank, score, content, title FROM m""")
def q_store_top_k_batch(spark, sf):
    store = EvidenceStore(spark, scratch_path(spark, "store"), recreate=True)
    store.write_documents(document_rows(spark, sf))
    return store.top_k_batch(_benchmark_claims(spark, sf), TOP_K).select(
        "claim_id", "doc_id", "rank", "score", "content", F.col("meta.title").alias("title"))


_VERDICT_LABEL, _VERDICT_PROB = S.pair("m.claim", "m.content")


@query("verify_claims", f"""
WITH {_store_cte()}, {_article_claims_sql('benchmark', ['item_id'], True)}, {_matches_sql(TOP_K)},
v AS (SELECT claim_id, doc_id, {_VERDICT_LABEL} AS label, {_VERDICT_PROB} AS prob FROM m)
SELECT * FROM v WHERE prob > 0.5 AND label <> 'NOT_ENOUGH_INFO'""")
def q_verify(spark, sf):
    return jobs.verify_claims(_benchmark_matches(spark, sf)).select("claim_id", "doc_id", "label", "prob")


@query("verify_claims_all", f"""
WITH {_store_cte()}, {_article_claims_sql('benchmark', ['item_id'], True)}, {_matches_sql(TOP_K)},
v AS (SELECT claim_id, doc_id, {_VERDICT_LABEL} AS label, {_VERDICT_PROB} AS prob FROM m)
SELECT * FROM v WHERE prob > 0.5""")
def q_verify_all(spark, sf):
    return jobs.verify_claims(_benchmark_matches(spark, sf), print_neutral=True).select(
        "claim_id", "doc_id", "label", "prob")


@query("verdict_report", f"""
WITH {_store_cte()}, {_article_claims_sql('benchmark', ['item_id'], True)}, {_matches_sql(TOP_K)},
v AS (SELECT claim_id, claim, rank - 1 AS evidence_no, title, {_VERDICT_LABEL} AS label, {_VERDICT_PROB} AS prob FROM m)
SELECT claim_id, claim, evidence_no, title, label, printf('%.2f', prob) AS prob FROM v WHERE prob > 0.5""")
def q_verdict_report(spark, sf):
    return jobs.verdict_report(jobs.verify_claims(_benchmark_matches(spark, sf), print_neutral=True))


_EXPORT_ABS = f"""
WITH {_store_cte()}, {_article_claims_sql('benchmark', ['item_id'], False)}, {_matches_sql(TOP_K_EXPORT)},
corpus AS (SELECT row_number() OVER (ORDER BY claim_id, rank) - 1 AS doc_id, claim_id, rank, title,
                  {S.sentences('content')} AS l FROM m)"""


def _export_files(spark, sf) -> str:
    """C9 end to end: claims (no gate) -> top-30 -> corpus and claim records -> JSON lines."""
    corpus, claims = jobs.export_abstracts(_benchmark_claims(spark, sf, gate=False), embedded_store(spark, sf))
    path = scratch_path(spark, "export")
    write_corpus_jsonl(corpus, f"{path}/corpus")
    write_claims_jsonl(claims, f"{path}/claims")
    return path


@query("export_corpus_abstracts", f"""{_EXPORT_ABS}
SELECT doc_id, title, array_to_string(l, ' | ') AS abstract, len(l)::INTEGER AS n_sentences FROM corpus""")
def q_export_corpus(spark, sf):
    corpus = spark.read.schema(CORPUS_RECORD).json(f"{_export_files(spark, sf)}/corpus")
    return corpus.select("doc_id", "title", joined("abstract").alias("abstract"),
                         F.size("abstract").alias("n_sentences"))


@query("export_claims", f"""{_EXPORT_ABS}
SELECT c.claim_id AS id, c.claim, coalesce(array_to_string(list(corpus.doc_id ORDER BY corpus.doc_id), ','), '')
       AS doc_ids, count(corpus.doc_id) AS n_docs
FROM claims c LEFT JOIN corpus USING (claim_id) GROUP BY c.claim_id, c.claim""")
def q_export_claims(spark, sf):
    claims = spark.read.schema(CLAIM_RECORD).json(f"{_export_files(spark, sf)}/claims")
    return claims.select("id", "claim", F.array_join(F.transform("doc_ids", lambda x: x.cast("string")), ",")
                         .alias("doc_ids"), F.size("doc_ids").cast("long").alias("n_docs"))


@query("export_corpus_titles", f"""
WITH {_store_cte()}, {_article_claims_sql('benchmark', ['item_id'], True)}, {_matches_sql(TOP_K)},
g AS (SELECT claim_id, coalesce(title, '') AS title, min(rank) AS first_rank,
             string_agg(content, ' | ' ORDER BY rank) AS abstract, count(*) AS n_quotes FROM m GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY claim_id, first_rank) - 1 AS doc_id, claim_id, title, first_rank, abstract,
       n_quotes FROM g""")
def q_export_titles(spark, sf):
    corpus, _ = jobs.export_titles(_benchmark_claims(spark, sf), embedded_store(spark, sf))
    return corpus.select("doc_id", "claim_id", "title", "first_rank", joined("abstract").alias("abstract"),
                         F.size("abstract").cast("long").alias("n_quotes"))


_PHRASES_SQL = f"""
WITH {_CLAIMS_CTE},
ph AS (SELECT row_number() OVER (ORDER BY {S.WORK_ID}, cl.pos) - 1 AS doc_id, cl.sentence AS text, d.source, d.lang
       FROM cl JOIN documents d USING (doc_id) WHERE {S.topic_yes('cl.sentence')}),
store AS (SELECT * FROM ph QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1),
{S.store_vectors_cte()}, {_article_claims_sql('benchmark', ['item_id'], True)}, {_matches_sql(TOP_K)},
g AS (SELECT claim_id, coalesce(title, '') AS title, min(rank) AS first_rank,
             string_agg(content, ' | ' ORDER BY rank) AS abstract, count(*) AS n_quotes FROM m GROUP BY 1, 2),
corpus AS (SELECT row_number() OVER (ORDER BY claim_id, first_rank) - 1 AS doc_id, * FROM g)"""


def _phrase_files(spark, sf) -> str:
    """C10 end to end: phrase store -> nearest phrases by title -> corpus and claim records -> JSON lines."""
    store = EvidenceStore(spark, scratch_path(spark, "phrases"), recreate=True)
    corpus, claims = jobs.export_phrases(_benchmark_claims(spark, sf), works_view(spark, sf).select(*WORK_COLS), store,
                                         CLAIM_THRESHOLD_SYNTHETIC)
    path = scratch_path(spark, "export")
    write_corpus_jsonl(corpus, f"{path}/corpus")
    write_claims_jsonl(claims, f"{path}/claims")
    return path


@query("export_phrases", f"""{_PHRASES_SQL}
SELECT doc_id, title, abstract, n_quotes FROM corpus""")
def q_export_phrases(spark, sf):
    corpus = spark.read.schema(CORPUS_RECORD).json(f"{_phrase_files(spark, sf)}/corpus")
    return corpus.select("doc_id", "title", joined("abstract").alias("abstract"), F.size("abstract").cast("long").alias("n_quotes"))


@query("export_phrase_claims", f"""{_PHRASES_SQL}
SELECT c.claim_id AS id, c.claim, coalesce(array_to_string(list(corpus.doc_id ORDER BY corpus.doc_id), ','), '')
       AS doc_ids, count(corpus.doc_id) AS n_docs
FROM claims c LEFT JOIN corpus USING (claim_id) GROUP BY c.claim_id, c.claim""")
def q_export_phrase_claims(spark, sf):
    claims = spark.read.schema(CLAIM_RECORD).json(f"{_phrase_files(spark, sf)}/claims")
    return claims.select("id", "claim", F.array_join(F.transform("doc_ids", lambda x: x.cast("string")), ",")
                         .alias("doc_ids"), F.size("doc_ids").cast("long").alias("n_docs"))


@query("topk_one", f"""
WITH {_store_cte()}, qv AS (SELECT {S.dense(S.buckets("'" + TOPK_PHRASE + "'"))} AS v)
SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id)::INTEGER AS rank, score
FROM (SELECT sv.doc_id, round({S.cosine('qv.v', 'sv.v')}, 6) AS score FROM qv, sv) QUALIFY rank <= {TOP_K}""")
def q_topk_one(spark, sf):
    store = embedded_store(spark, sf)
    qv = spark.range(1).select(hash_embedding(F.lit(TOPK_PHRASE)).alias("v")).first()["v"]
    return knn.topk_single(store, list(qv), TOP_K, "cosine").select("doc_id", "rank", "score")


@query("store_top_k", ORACLES["topk_one"])
def q_store_top_k(spark, sf):
    store = EvidenceStore(spark, scratch_path(spark, "store"), recreate=True)
    store.write_documents(document_rows(spark, sf))
    return store.top_k(TOPK_PHRASE, TOP_K).select("doc_id", "rank", "score")


# ----------------------------------------------------------------------------- streaming / UDF surface

@query("stream_ingest", "SELECT DISTINCT sha256(coalesce(text, '')) AS doc_key, length(coalesce(text, '')) AS n_chars "
       "FROM documents")
def q_stream_ingest(spark, sf):
    from veriscope.streaming.ingest import ingest_pages
    docs = load(spark, sf, "documents")
    landing = scratch_path(spark, "landing")
    # Two overlapping landings of the whole table, in differently cut files.
    docs.write.json(f"{landing}/a")
    docs.repartition("doc_id").write.json(f"{landing}/b")
    store = EvidenceStore(spark, scratch_path(spark, "stream-store"), recreate=True)

    def to_docs(batch):
        return batch.select("doc_id", F.col("text").alias("content"),
                            F.struct(F.col("source").alias("title"), F.lit(None).cast("int").alias("publication_year"),
                                     F.lit("").alias("authors"), F.lit("").alias("doi"),
                                     F.lit("").alias("open_alex_id")).alias("meta"))

    ingest_pages(spark, f"{landing}/*", docs.schema, store, to_docs, scratch_path(spark, "stream-ckpt"),
                 max_files_per_trigger=32)
    return store.read().select("doc_key", F.length(F.coalesce("content", F.lit(""))).cast("long").alias("n_chars"))


@query("ingest_incremental", ORACLES["stream_ingest"])
def q_ingest_incremental(spark, sf):
    """Overlapping landings into a bucketed store: each micro-batch reads only buckets that may hold its keys."""
    from veriscope.streaming.ingest import ingest_pages
    docs = document_rows(spark, sf)
    landing = scratch_path(spark, "landing")
    docs.write.json(f"{landing}/a")
    docs.repartition(6, "doc_id").write.json(f"{landing}/b")
    store = EvidenceStore(spark, scratch_path(spark, "bucket-store"), recreate=True, buckets=32)
    ingest_pages(spark, f"{landing}/*", docs.schema, store, lambda b: b, scratch_path(spark, "bucket-ckpt"), max_files_per_trigger=24)
    return store.read().select("doc_key", F.length(F.coalesce("content", F.lit(""))).cast("long").alias("n_chars"))


@query("stream_ingest_works", f"""
WITH {_INVERT_SQL}
SELECT DISTINCT sha256(abstract) AS doc_key, length(abstract)::BIGINT AS n_chars FROM abs""")
def q_stream_ingest_works(spark, sf):
    """S2 over landed work pages: two overlapping landings streamed page by page into the store."""
    from veriscope.schemas import RAW_WORK
    from veriscope.operators.filters import to_documents
    from veriscope.streaming.ingest import ingest_pages
    landing = scratch_path(spark, "work-pages")
    raw_works(spark, sf).write.json(f"{landing}/first")
    raw_works(spark, sf, deal="doc_id").write.json(f"{landing}/again")
    store = EvidenceStore(spark, scratch_path(spark, "works-store"), recreate=True)
    ingest_pages(spark, f"{landing}/*", RAW_WORK, store, lambda b: to_documents(flatten_works(b)),
                 scratch_path(spark, "work-pages-ckpt"), max_files_per_trigger=32)
    return store.read().select("doc_key", F.length("content").cast("long").alias("n_chars"))


def _count_words(pdf):
    import pandas as pd
    n = pdf["text"].fillna("").str.lower().str.count("[a-z]+")
    return pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": n.astype("int64")})


@query("partition_map", f"SELECT doc_id, len({S.words("coalesce(text, '')")})::BIGINT AS n_words "
       "FROM documents")
def q_partition_map(spark, sf):
    return partition_map(load(spark, sf, "documents").select("doc_id", "text"), _count_words,
                         "doc_id long, n_words long")


@query("topic_naive_bayes", f"""
WITH k AS (SELECT l.quality AS label, d.text FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IN (0, 1)),
prior AS (SELECT round(ln(coalesce(sum(label), 0) + 1) * 1000000)::BIGINT
                 - round(ln(coalesce(sum(1 - label), 0) + 1) * 1000000)::BIGINT AS prior FROM k),
kw AS (SELECT label, unnest({S.words("coalesce(text, '')")}) AS word FROM k),
c AS (SELECT word, sum(label) AS n1, sum(1 - label) AS n0 FROM kw GROUP BY word),
t AS (SELECT sum(n1) AS t1, sum(n0) AS t0, count(*) AS v FROM c),
w AS (SELECT word, round(ln((n1 + 1)::DOUBLE / (t1 + v)::DOUBLE) * 1000000)::BIGINT
                   - round(ln((n0 + 1)::DOUBLE / (t0 + v)::DOUBLE) * 1000000)::BIGINT AS weight FROM c, t),
dw AS (SELECT doc_id, unnest({S.words("coalesce(text, '')")}) AS word FROM documents),
m AS (SELECT d.doc_id, (any_value(prior) + coalesce(sum(w.weight), 0))::BIGINT AS margin
      FROM documents d CROSS JOIN prior LEFT JOIN dw USING (doc_id) LEFT JOIN w USING (word) GROUP BY d.doc_id)
SELECT doc_id, CASE WHEN margin >= 0 THEN 'Yes' ELSE 'No' END AS topic_label,
       round(1 / (1 + exp(-abs(margin) / 1000000)), 6) AS topic_score, margin FROM m""")
def q_topic_naive_bayes(spark, sf):
    docs = load(spark, sf, "documents")
    labels = load(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return bayes.classify(docs, *bayes.train(docs.join(labels, "doc_id")))


def _benchmark_searches(spark, sf):
    """One search an item: two groups, the three-word phrases that start in its words' first and second half."""
    items = load(spark, sf, "benchmark").select("item_id", words(F.coalesce("text", F.lit(""))).alias("ws")).where(F.size("ws") >= 4)
    at = F.explode(F.sequence(F.lit(1), F.size("ws") - 2)).alias("i")
    phrases = items.select("item_id", "ws", at).select(
        "item_id", F.when(F.col("i") * 2 <= F.size("ws") - 1, 0).otherwise(1).alias("group_no"),
        F.concat(F.lit('"'), F.array_join(F.slice("ws", F.col("i"), F.lit(3)), " "), F.lit('"')).alias("p"))
    return phrases.groupBy("item_id", "group_no").agg(F.array_join(F.collect_set("p"), " OR ").alias("group_text")) \
        .withColumnRenamed("item_id", "search_id")


@query("concept_search_many", f"""
WITH i AS (SELECT item_id, {S.words("coalesce(text, '')")} AS ws FROM benchmark),
g AS (SELECT item_id, ws, unnest(range(1, len(ws) - 1)) AS k FROM i WHERE len(ws) >= 4),
p AS (SELECT DISTINCT item_id AS search_id, CASE WHEN k * 2 <= len(ws) - 1 THEN 0 ELSE 1 END AS group_no,
             ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2] AS phrase FROM g),
r AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9 \t\n\r]+')) AS piece FROM documents),
t AS (SELECT doc_id, list_filter(regexp_split_to_array(piece, '[ \t\n\r]+'), lambda x: x <> '') AS ws FROM r),
k AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS k FROM t WHERE len(ws) >= 3),
post AS (SELECT DISTINCT doc_id, ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2] AS phrase FROM k),
f AS (SELECT search_id, doc_id, count(DISTINCT group_no) AS g, count(*) AS n_phrases FROM post JOIN p USING (phrase) GROUP BY 1, 2)
SELECT search_id, doc_id, n_phrases FROM f WHERE g = 2""")
def q_concept_search_many(spark, sf):
    return concepts.search_many(load(spark, sf, "documents"), _benchmark_searches(spark, sf))


@query("ml_topic")
def q_ml_topic(spark, sf):
    docs = load(spark, sf, "documents")
    train = docs.join(load(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    model = fit_topic_model(train)
    return apply_topic_model(model, docs.select("doc_id", "text")).select("doc_id", "topic_label", "topic_score")
