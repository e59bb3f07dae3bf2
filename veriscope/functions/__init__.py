"""Column-level building blocks. Everything here returns a ``Column`` and stays JVM-side,
except ``bucket_counts`` which is an Arrow-batched pandas UDF (numpy bincount)."""

from veriscope.functions.text import (  # noqa: F401
    article_text, authors_string, coalesce_abstract, collapse_ws, doc_key, embed_input,
    first_line, sentences, uninvert_abstract, words,
)
from veriscope.functions.vectors import (  # noqa: F401
    bucket_counts, cosine_expr, dot_expr, format_prob, format_similarity, hash_buckets,
    hash_embedding, norm_expr,
)
