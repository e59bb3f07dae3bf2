"""String / array / map column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veriscope.constants import SENTENCE_PATTERN, WHITESPACE_PATTERN, WORD_PATTERN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c) -> Column:
    """Runs of whitespace to one space, then trim."""
    return F.trim(F.regexp_replace(_c(c), WHITESPACE_PATTERN, " "))


def words(c) -> Column:
    """Lower-case ASCII word tokens of a text (whole text, every word)."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(WORD_PATTERN), 0)


def first_line(c) -> Column:
    return F.substring_index(_c(c), "\n", 1)


def uninvert_abstract(m) -> Column:
    """inverted index (word -> positions) back to text.

    Entries are ordered by their position list and the words joined by a space, so
    every distinct word appears once, at its first position.  Null stays null.
    """
    m = _c(m)
    # sort_array orders with a native comparator (array_sort's default comparator is a lambda)
    by_pos = F.sort_array(F.transform(F.map_entries(m),
                                      lambda e: F.struct(e["value"].alias("pos"), e["key"].alias("word"))))
    return F.when(m.isNull(), F.lit(None)).otherwise(
        F.array_join(F.transform(by_pos, lambda x: x["word"]), " "))


def authors_string(authorships) -> Column:
    """author display names in order joined by ', '.

    A null name is dropped; a missing name (or missing author) counts as ''.
    """
    a = _c(authorships)
    names = F.transform(a, lambda x: F.when(
        F.coalesce(F.map_contains_key(x["author"], F.lit("display_name")), F.lit(False)),
        F.try_element_at(x["author"], F.lit("display_name"))).otherwise(F.lit("")))
    return F.array_join(F.filter(names, lambda n: n.isNotNull()), ", ")


def sentences(c) -> Column:
    """text -> ordered, whitespace-normalised, non-empty sentences (rule based)."""
    flat = F.regexp_replace(_c(c), WHITESPACE_PATTERN, " ")
    parts = F.regexp_extract_all(flat, F.lit(SENTENCE_PATTERN), 0)
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


# Elements whose content is not article text.
_DROP_BLOCKS = [
    "(?s)<!--.*?-->",
    "(?s)<script[^>]*>.*?</script>",
    "(?s)<style[^>]*>.*?</style>",
    "(?s)<nav[^>]*>.*?</nav>",
    "(?s)<footer[^>]*>.*?</footer>",
]
# HTML entities decoded after tags are stripped ("&amp;" last).
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def article_text(html) -> Column:
    """main text of a web page: the <article> element (else <body>, else the
    whole page) without comments, scripts, styles, navigation and footers; tags
    stripped, common entities decoded, whitespace collapsed."""
    h = _c(html)
    art = F.regexp_extract(h, "(?s)<article[^>]*>(.*)</article>", 1)
    body = F.regexp_extract(h, "(?s)<body[^>]*>(.*)</body>", 1)
    main = F.coalesce(F.nullif(art, F.lit("")), F.nullif(body, F.lit("")), h)
    for pat in _DROP_BLOCKS:
        main = F.regexp_replace(main, pat, " ")
    main = F.regexp_replace(main, "<[^>]*>", " ")
    for ent, ch in _ENTITIES:
        main = F.replace(main, F.lit(ent), F.lit(ch))
    return collapse_ws(main)


def coalesce_abstract(enriched, original) -> Column:
    """the enriched abstract when non-empty, else the original."""
    return F.coalesce(F.nullif(_c(enriched), F.lit("")), _c(original))


def doc_key(content) -> Column:
    """content identity used to skip duplicates."""
    return F.sha2(F.coalesce(_c(content), F.lit("")), 256)


def embed_input(title, content) -> Column:
    """the title is embedded together with the content."""
    return F.concat_ws("\n", _c(title), _c(content))
