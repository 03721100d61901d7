"""SQL text for oracle checks, generated from the same fixed rule tables the
operators use (the rules are data; the oracle checks the Spark mechanics)."""

from __future__ import annotations

from ratebook.fixed import (DEFAULT_SUB, DEFAULT_TOP, HSN_RANGE_RULES,
                            KEYWORD_RULES, KEYWORD_SUB)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def chapter_sql(code: str) -> str:
    return f"(CASE WHEN length({code}) >= 2 THEN TRY_CAST(substr({code}, 1, 2) AS INTEGER) END)"


def range_case(code: str, part: str, rules=HSN_RANGE_RULES) -> str:
    """CASE giving top (part='top') or sub (part='sub') from chapter ranges, or NULL."""
    ch = chapter_sql(code)
    idx = 2 if part == "top" else 3
    whens = " ".join(f"WHEN {ch} BETWEEN {r[0]} AND {r[1]} THEN {q(r[idx])}" for r in rules)
    return f"(CASE {whens} END)"


def keyword_case(text: str, part: str, rules=KEYWORD_RULES, sub_map=KEYWORD_SUB) -> str:
    low = f"lower(coalesce({text}, ''))"
    whens = []
    for kw, top in rules:
        v = top if part == "top" else sub_map.get(kw, DEFAULT_SUB)
        whens.append(f"WHEN contains({low}, {q(kw)}) THEN {q(v)}")
    return f"(CASE {' '.join(whens)} END)"


def classify_sql(text: str | None, code: str, part: str, kw_rules=KEYWORD_RULES,
                 sub_map=KEYWORD_SUB, range_rules=HSN_RANGE_RULES) -> str:
    default = DEFAULT_TOP if part == "top" else DEFAULT_SUB
    parts = []
    if text is not None:
        parts.append(keyword_case(text, part, kw_rules, sub_map))
    parts.append(range_case(code, part, range_rules))
    parts.append(q(default))
    return "coalesce(" + ", ".join(parts) + ")"


def dec_text_sql(x: str) -> str:
    """Canonical decimal text, same rule as ratebook.functions.dec_text."""
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(12,6)) AS VARCHAR), '\\.?0+$', '')"
