"""SQL fragments shared by the oracle queries (DuckDB dialect)."""

from tabrix.functions.nulls import DEFAULT_NULL_TOKENS, NUMERIC_PATTERN
from tabrix.functions.text import ENGLISH_STOP_WORDS, URL_PATTERN


def sql_list(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def strip(col: str) -> str:
    return f"regexp_replace({col}, '^\\s+|\\s+$', '', 'g')"


TOKENS = sql_list(sorted(DEFAULT_NULL_TOKENS))
STOPWORDS = sql_list(sorted(set(ENGLISH_STOP_WORDS)))
NUMERIC_RE = NUMERIC_PATTERN


def safe_double(col: str) -> str:
    return (f"CASE WHEN regexp_matches({col}, '{NUMERIC_RE}') "
            f"THEN TRY_CAST(trim({col}) AS DOUBLE) END")


def normalize(col: str) -> str:
    return (f"coalesce(array_to_string(list_filter(regexp_extract_all("
            f"regexp_replace(lower({col}), '{URL_PATTERN}', ' ', 'g'), '[a-z0-9]+'), "
            f"lambda x: x NOT IN {STOPWORDS}), ' '), '')")
