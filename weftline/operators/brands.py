"""Brand names in product titles."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions.vectors import let

# Patterns and word lists.
SKIP_PATTERNS = (
    r"(?i)\b(and|or|the|of|for|with|by|in|on|at|to|from)\b",
    r"(?i)\b(design|studio|designs?|collection|series|set|kit|pack|bundle)\b",
    r"(?i)\b(inc|corp|ltd|llc|co|company|corporation)\b",
    r"(?i)\b(limited|unlimited|international|global|worldwide)\b",
    r"^\d+",
    r"\d+$",
)
SCORED_BRANDS = ("apple", "samsung", "nike", "sony", "microsoft", "canon", "nintendo", "disney", "lego", "marvel")
LEADING_PHRASE = r"^([A-Z][a-zA-Z0-9&'\.\-\s]{1,15})\s+(?:by\s+)?[A-Z]"
LEADING_PRODUCT = r"^([A-Z][a-zA-Z0-9&'\.\-\s]{1,15})\s+(?:Set|Kit|Pack|Bundle|Console|Camera|Phone)"
# (pattern, group to take)
TITLE_PATTERNS = (
    (r"Amazon\s+\w+", 0),
    (r"Solimo\b", 0),
    (r"Goodthreads\b", 0),
    (r"Lark\s+&\s+Ro\b", 0),
    (r"Stone\s+&\s+Beam\b", 0),
    (r"Daily\s+Ritual\b", 0),
    (r"^([A-Z][a-zA-Z0-9&'\.\-\s]{1,30})\s+(?:by\s+)?[A-Z]", 1),
    (r"^([A-Z][a-zA-Z0-9&'\.\-\s]{1,20})\s+(?:Set|Kit|Pack|Bundle)", 1),
    (r"\bby\s+([A-Z][a-zA-Z0-9&'\.\-\s]{1,30})\b", 1),
    (r"\bfrom\s+([A-Z][a-zA-Z0-9&'\.\-\s]{1,30})\b", 1),
    (r"([A-Za-z0-9&'\.\-\s]+)\s?[®™]", 1),
    (r"\b(?:Nintendo|PlayStation|Xbox|Steam|Epic\s+Games)\b", 0),
    (r"\b(?:Pokemon|Pokémon|Mario|Zelda|Sonic)\b", 0),
    (r"\b(?:Nike|Adidas|Puma|Reebok|Under\s+Armour)\b", 0),
    (r"\b(?:Gap|H&M|Zara|Uniqlo|Forever\s+21)\b", 0),
)
COMMON_WORDS = (
    "the", "a", "an", "and", "or", "in", "on", "at", "to", "for", "of", "with", "by", "from", "official", "kids",
    "child", "children", "men", "women", "adult", "jr", "jr.", "boys", "girls", "set", "pack", "bundle", "kit", "toy",
    "game", "book", "dvd", "cd", "blu-ray", "digital", "download", "online", "free", "sale", "discount", "clearance",
    "new", "used", "refurbished", "vintage",
)


def known_brand(title: Column, brands: list[str]) -> Column:
    """Longest known brand contained in the title, as written there, in title case."""
    found = _longest_contained(F.lower(title), brands)
    return let(found, lambda b: X.title_case(F.substr(title, F.position(b, F.lower(title)), F.length(b))))


def _longest_contained(text: Column, names: list[str]) -> Column:
    """Longest of ``names`` inside the text, the first listed of equally long ones; looked up by length, not scanned."""
    ranked = sorted(dict.fromkeys(n for n in names if n), key=len, reverse=True)

    @F.pandas_udf("string")
    def longest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # names by length: a text is cut into pieces of each length that occurs, and pieces are looked up
        by_length: dict[int, dict[str, int]] = {}
        for place, name in enumerate(ranked):
            by_length.setdefault(len(name), {})[name] = place

        def one(t: str | None) -> str | None:
            for n, table in by_length.items():
                hits = [table[p] for i in range(len(t or "") - n + 1) if (p := t[i:i + n]) in table]
                if hits:
                    return ranked[min(hits)]
            return None

        for batch in batches:
            yield pd.Series([one(t) for t in batch], index=batch.index, dtype=object)

    return longest(text)


def best_candidate(title: Column, candidates: Column) -> Column:
    """Best organisation name among candidates; the first one wins a tie."""
    def fits(c: Column) -> Column:
        keep = F.length(c).between(2, 30)
        for p in SKIP_PATTERNS:
            keep = keep & ~c.rlike(p)
        return keep

    def score(c: Column) -> Column:
        low = F.lower(c)
        known = F.lit(False)
        for b in SCORED_BRANDS:
            known = known | F.contains(low, F.lit(b))
        return (F.when(F.lower(title).startswith(low), 10).otherwise(0) + F.when(known, 15).otherwise(0)
                - F.when(F.length(c) > 20, 5).otherwise(0))

    scored = F.transform(F.filter(candidates, fits),
                         lambda c, i: F.struct((-score(c)).alias("s"), i.alias("i"), c.alias("c")))
    return F.array_min(scored)["c"]


def leading_phrase(title: Column) -> Column:
    """Fallback: capitalised phrase at the start, before a capital word or a product noun."""
    def accepted(pattern: str) -> Column:
        return let(X.strip(F.regexp_extract(title, pattern, 1)),
                   lambda b: F.when(F.length(b).between(2, 19), b))

    return F.coalesce(accepted(LEADING_PHRASE), accepted(LEADING_PRODUCT))


def hybrid_brand(title: Column, brands: list[str], candidates: Column | None = None) -> Column:
    """Known brand, else best candidate, else leading phrase; null for no title."""
    steps = [known_brand(title, brands)] if brands else []
    if candidates is not None:
        steps.append(best_candidate(title, candidates))
    return F.when(title != "", F.coalesce(*steps, leading_phrase(title)))


def pattern_brand(title: Column) -> Column:
    """First surviving match of the ordered patterns; empty when none survives."""
    t = X.strip(title)
    found = F.concat(*[F.regexp_extract_all(t, F.lit("(?iu)" + p), F.lit(g)) for p, g in TITLE_PATTERNS])
    clean = F.transform(found, lambda m: F.regexp_replace(X.strip(m), "^[®™\"']+|[®™\"']+$", ""))
    good = F.filter(clean, lambda b: (F.length(b) > 1) & ~b.rlike(r"^\d+$") & ~F.lower(b).isin(*COMMON_WORDS))
    return F.coalesce(F.get(good, F.lit(0)), F.lit(""))


def model_or_pattern(model_brand: Column, title: Column) -> Column:
    """A model's answer where there is one, else the patterns; empty for no title."""
    return F.when(F.coalesce(title, F.lit("")) == "", "").otherwise(
        F.coalesce(F.nullif(model_brand, F.lit("")), pattern_brand(title), F.lit("")))


def extraction_stats(rows: DataFrame, brand: str = "brand") -> DataFrame:
    """Totals and rates; rates are null for an empty table."""
    found = F.count_if(F.coalesce(F.col(brand), F.lit("")) != "")
    total = F.count(F.lit(1))
    return rows.agg(total.alias("total"), found.alias("found")).select(
        "total", "found",
        F.try_divide("found", "total").alias("success_rate"),
        (1 - F.try_divide("found", "total")).alias("blank_rate"))


def top_values(rows: DataFrame, column: str = "brand", n: int = 10) -> DataFrame:
    """Most frequent values; ties in value order."""
    # a filter on the rows would compute the value a second time; null and the empty text are two groups at most
    best = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(n + 2)
    return best.filter(F.coalesce(F.col(column), F.lit("")) != "").orderBy(F.desc("n"), column).limit(n)
