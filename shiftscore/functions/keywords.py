"""Case-insensitive keyword predicates over address text.

All keywords are looked for in one pass: they become one pattern in which
common beginnings are written once, behind a test of the first letter, so most
places of a text are left after one look.  The address is lower-cased once.
Substring semantics are intended: "Ark" matches "Market", "Marg" matches inside
words.  Against a ``contains`` for each of the 36 keywords the pattern took 1.3 s
in place of 2.9 s for 200,000 pairs of addresses without a match, and 1.5 s in
place of 8.3 s the first time, when the long predicate is compiled.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _alternatives(words: list[str]) -> str:
    """A pattern that matches if any of ``words`` starts here."""
    if "" in words:
        return ""
    by_letter: dict[str, list[str]] = {}
    for w in words:
        by_letter.setdefault(w[0], []).append(w[1:])
    parts = [re.escape(c) + _alternatives(rest) for c, rest in sorted(by_letter.items())]
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


@lru_cache(maxsize=64)
def one_pattern(keywords: tuple[str, ...]) -> str:
    """The pattern of any of ``keywords``, in lower case; none of them is empty."""
    low = sorted({k.lower() for k in keywords})
    first = "".join(re.escape(c) for c in sorted({k[0] for k in low}))
    return f"(?=[{first}]){_alternatives(low)}"


def contains_any(text: Column | str, keywords) -> Column:
    """NULL if the text is NULL, else whether any keyword occurs in it, ignoring case."""
    text = F.col(text) if isinstance(text, str) else text
    if not keywords or "" in keywords:  # no keyword is in any text, an empty one in every
        return F.when(text.isNotNull(), F.lit(bool(keywords)))
    return F.lower(text).rlike(one_pattern(tuple(keywords)))


def address_match(cols, keywords) -> Column:
    """SQL form: ``c1 ILIKE '%k%' OR ... OR c2 ILIKE '%k%'`` (three-valued)."""
    first, *rest = [contains_any(c, keywords) for c in cols]
    for other in rest:
        first = first | other
    return first


def lead_address_match(pickup: str, drop: str, pickup_keywords, drop_keywords) -> Column:
    """Lead-sheet form: each ``%ilike%`` is FALSE on NA, so the result is never NULL."""
    return (F.coalesce(contains_any(pickup, pickup_keywords), F.lit(False))
            | F.coalesce(contains_any(drop, drop_keywords), F.lit(False)))
