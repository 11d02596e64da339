"""Text matching functions (F5, F6, L4) as built-in array expressions.

One documented tokeniser treats texts and keywords alike: lower case; every
Han character is a token of its own, as such text has no spaces; what is left
is split on every run of characters that are neither letters nor digits.  The
same rule is written in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
HAN = r"(\p{IsHan})"
# A letter or digit that would make a hit part of a longer token.
INSIDE = r"[\p{L}\p{N}&&[^\p{IsHan}]]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c) -> Column:
    """ARRAY<STRING> of the tokens of a text column (whole text)."""
    apart = F.regexp_replace(F.lower(_c(c)), HAN, " $1 ")
    return F.filter(F.split(apart, TOKEN_SPLIT), lambda t: t != F.lit(""))


def keyword_tokens(keyword: str) -> Column:
    """Distinct tokens of a query string, in order, by the same rule (a
    constant that the planner folds)."""
    return F.array_distinct(tokens(F.lit(keyword or "")))


def match_all(token_col, keyword: str) -> Column:
    """Every keyword token is present (F5).  An empty keyword matches nothing.
    The tokens of a row are computed once for all keyword tokens."""
    kw = keyword_tokens(keyword)
    return (F.size(kw) > 0) & (F.size(F.array_intersect(kw, _c(token_col))) == F.size(kw))


def match_any(token_col, keyword: str) -> Column:
    """At least one keyword token is present."""
    return F.arrays_overlap(token_col, keyword_tokens(keyword))


def highlight(c, keyword: str, pre: str = "<em>", post: str = "</em>") -> Column:
    """Wrap every hit of a whole keyword token, in any case (L4).  Tokens are
    letters and digits only, so they need no quoting."""
    kw = keyword_tokens(keyword)
    pattern = F.concat(F.lit(f"(?iu)(?<!{INSIDE})("), F.array_join(kw, "|"), F.lit(f")(?!{INSIDE})"))
    hit = F.regexp_replace(_c(c), pattern, F.lit(f"{pre}$1{post}"))
    return F.when(F.size(kw) > 0, hit).otherwise(_c(c))


def count_token(token_col, tok: str) -> Column:
    """Term frequency of one token in a token array."""
    return F.size(F.filter(token_col, lambda t: t == F.lit(tok)))
