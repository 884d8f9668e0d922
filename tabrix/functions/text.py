"""Text normalisation as native Spark expressions (no UDF).

Chain (``text.normalize``): lower -> strip URLs -> regex tokens ``[a-z0-9]+`` ->
drop stop words -> optional lemma lookup -> join with one space. The reference
falls back to exactly this regex tokeniser when its NLP toolkit is missing; we
make the fallback the definition. Punctuation and non-alphanumeric token
filters are implied by the token pattern.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.functions.nulls import quoted, strip_ws

# URL and token patterns of the reference text cleaner.
URL_PATTERN = r"https?://\S+|www\.\S+"
TOKEN_PATTERN = r"[a-z0-9]+"

# The classic 179-word English stop-word list (NLTK "english").
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below",
    "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll",
    "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn",
    "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)

# Above this many entries a lemma dictionary is joined instead of inlined.
MAX_INLINE_LEMMAS = 5000


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL_PATTERN, " ")


def tokenize(c: Column) -> Column:
    """``[a-z0-9]+`` tokens of the lower-cased text (array<string>)."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


def drop_stopwords(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Keep order and repeats (unlike ``array_except``); ``IN`` over a literal
    list becomes a hash-set lookup (``INSET``) in the optimiser."""
    words = sorted(set(stop_words))
    if not words:
        return tokens
    return F.filter(tokens, lambda x: ~x.isin(words))


def lemmatize_inline(tokens: Column, lemmas: Mapping[str, str]) -> Column:
    if not lemmas:
        return tokens
    if len(lemmas) > MAX_INLINE_LEMMAS:
        raise ValueError("lemma table too large to inline; use lemmatize_join")
    flat = []
    for k, v in sorted(lemmas.items()):
        flat.extend([F.lit(k), F.lit(v)])
    m = F.create_map(*flat)
    return F.transform(tokens, lambda x: F.coalesce(F.try_element_at(m, x), x))


def normalize_expr(
    c: Column,
    lowercase: bool = True,
    remove_urls: bool = True,
    remove_stopwords: bool = True,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    lemmas: Mapping[str, str] | None = None,
    legacy_nan_text: bool = False,
) -> Column:
    """``text.normalize`` for one column; NULL -> '' (or 'nan' in legacy mode)."""
    s = c.cast("string")
    if legacy_nan_text:
        s = F.coalesce(s, F.lit("nan"))
    if lowercase:
        s = F.lower(s)
    if remove_urls:
        s = strip_urls(s)
    toks = tokenize(s)
    if remove_stopwords:
        toks = drop_stopwords(toks, stop_words)
    if lemmas:
        toks = lemmatize_inline(toks, lemmas)
    return F.coalesce(F.array_join(toks, " "), F.lit(""))


def normalize_columns(df: DataFrame, columns: Sequence[str], **kwargs) -> DataFrame:
    """``text.normalize_columns``: normalise the present columns in one select."""
    present = set(c for c in columns if c in df.columns)
    return df.select(*[
        normalize_expr(quoted(c), **kwargs).alias(c) if c in present else quoted(c)
        for c in df.columns
    ])


def lemmatize_join(df: DataFrame, key: str, tokens_col: str, lemma_table: DataFrame,
                   out: str | None = None) -> DataFrame:
    """Lemma lookup for dictionaries too large to inline.

    ``lemma_table(token, lemma)``: explode tokens with their position, left join
    the table (Spark picks broadcast or shuffle by size), re-assemble in
    position order per key. ``key`` must be unique per row.
    """
    out = out or tokens_col
    exploded = df.select(quoted(key), F.posexplode_outer(quoted(tokens_col)).alias("__p", "__t"))
    lem = lemma_table.select(F.col("token").alias("__t"), F.col("lemma").alias("__l"))
    joined = exploded.join(lem, on="__t", how="left")
    regrouped = joined.groupBy(quoted(key)).agg(
        F.array_sort(F.collect_list(F.when(F.col("__t").isNotNull(), F.struct(
            F.col("__p"), F.coalesce(F.col("__l"), F.col("__t")).alias("w"))))).alias("__arr")
    ).select(quoted(key), F.transform("__arr", lambda s: s["w"]).alias(out))
    base = df.drop(out) if out in df.columns else df
    return base.join(regrouped, on=key, how="left")


def combine_columns(df: DataFrame, sources: Sequence[str], out: str,
                    drop_sources: bool = True) -> DataFrame:
    """``text.combine``: join present sources with one space (NULL -> ''), strip.

    No source present -> ''. Sources are dropped unless ``drop_sources=False``.
    """
    present = [c for c in sources if c in df.columns]
    if present:
        joined = strip_ws(F.concat_ws(" ", *[F.coalesce(quoted(c).cast("string"), F.lit(""))
                                             for c in present]))
    else:
        joined = F.lit("")
    keep = [quoted(c) for c in df.columns if not (drop_sources and c in present) and c != out]
    return df.select(*keep, joined.alias(out))
