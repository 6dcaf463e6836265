"""String expressions.  All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.vectors import let

# What separates tokens.  The second set also splits at colon and semicolon.
TOKEN_SEPARATORS_V1 = r'[,.?_!"()\']|--|\s'
TOKEN_SEPARATORS_V2 = r'[,.:;?_!"()\']|--|\s'
_MARK = "\u0001"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space of every kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def split_words(c: Column | str) -> Column:
    """Words between runs of white space."""
    return F.filter(F.split(col(c), r"\s+"), lambda w: w != "")


def word_tokens(c: Column | str, separators: str = TOKEN_SEPARATORS_V2) -> Column:
    """Words and punctuation; separators are kept as tokens, blank tokens are not."""
    marked = F.regexp_replace(col(c), f"({separators})", f"{_MARK}$1{_MARK}")
    return F.filter(F.split(marked, _MARK), lambda t: t.rlike(r"\S"))


def capitalize(c: Column | str) -> Column:
    """First letter upper, the rest lower (``initcap`` would touch every word)."""
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def title_case(c: Column | str) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others."""
    def shape(chars: Column) -> Column:
        return F.transform(
            chars,
            lambda ch, i: F.when(
                (i == 0) | ~F.coalesce(F.get(chars, i - 1), F.lit("")).rlike(r"\p{L}"), F.upper(ch)
            ).otherwise(ch),
        )

    return F.array_join(let(F.split(F.lower(col(c)), ""), shape), "")


def before(c: Column, mark: str) -> Column:
    """Text up to the first ``mark``, or all of it."""
    return F.substring_index(c, mark, 1)


def after_last(c: Column, mark: str) -> Column:
    """Text behind the last ``mark``, or all of it."""
    return F.substring_index(c, mark, -1)


def after_first(c: Column, mark: str) -> Column:
    """Text behind the first ``mark``; null when there is none."""
    at = F.instr(c, mark)
    return F.when(at > 0, F.substr(c, at + len(mark)))


def cut(c: Column, n: int | None) -> Column:
    """The first ``n`` characters; None: all."""
    return c if n is None else F.substring(c, 1, n)


def named(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")
