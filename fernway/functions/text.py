"""Text expressions that stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Patterns. Whitespace is what Python's ``str.split`` splits on.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
NON_WORD = r"[^\p{L}\p{N}]+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CODE = r"\b[A-Z]{2,5}-[0-9]+\b"


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def exploded(df: DataFrame, keep: list[str | Column], array: Column, name: str) -> DataFrame:
    """A row per element of ``array``, null elements dropped. For an inner explode Spark also
    filters by the size of the array, which computes a costly expression twice."""
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def strip(text: Column) -> Column:
    """The text without white space at both ends, as ``str.strip`` takes it."""
    return F.regexp_replace(text, rf"^{WHITESPACE}|{WHITESPACE}\z", "")


def words(text: Column) -> Column:
    """Whitespace-separated tokens, empty ones dropped."""
    return F.filter(F.split(text, WHITESPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), NON_WORD), lambda w: w != "")


def ngrams(tokens: Column, n: int) -> Column:
    """Array of ``n`` neighbouring tokens joined by a space; linear in the text."""
    count = F.greatest(F.size(tokens) - n + 1, F.lit(0))
    shifted = F.arrays_zip(*[F.slice(tokens, i + 1, count).alias(f"g{i}") for i in range(n)])
    return F.transform(shifted, lambda g: F.concat_ws(" ", *[g[f"g{i}"] for i in range(n)]))


def literal_map(pairs: dict) -> Column:
    """A constant map column."""
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def weighted_hits(text: Column, weights: dict[str, int]) -> Column:
    """Sum of the weights of all listed terms in the text; no shuffle."""
    if not weights:
        return F.lit(0)
    table, listed = literal_map(weights), list(weights)
    return F.aggregate(
        F.filter(terms(text), lambda t: t.isin(listed)),
        F.lit(0),
        lambda acc, t: acc + table[t],
    )


def render(template: str, slots: dict[str, Column]) -> Column:
    """Fill ``{name}`` slots of a fixed template."""
    out, rest = [], template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            out.append(F.lit(head))
        if not brace:
            break
        slot, _, rest = tail.partition("}")
        out.append(slots[slot].cast("string"))
    return F.concat(*out)


def email_addresses(text: Column) -> Column:
    """All ``(name, email)`` pairs in a text; the name is the part before ``@``."""
    found = F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0))
    return F.transform(
        found,
        lambda e: F.struct(F.substring_index(e, "@", 1).alias("name"), e.alias("email")),
    )


def codes(text: Column) -> Column:
    """Ticket, error and account codes such as ``ABC-123``."""
    return F.regexp_extract_all(text, F.lit(CODE), F.lit(0))


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
