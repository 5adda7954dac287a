"""Column expressions. All of them stay inside generated JVM code."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendframe import schema as S

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# --- fixed values: the white space that text stripping removes
_WHITE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
          "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# runs of cased letters, and the runs between them
_WORDS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space; plain ``trim`` takes spaces only."""
    return F.btrim(col(c), F.lit(_WHITE))


def bare_number(c: Column | str) -> Column:
    """Text without currency and grouping marks; plain numbers skip the replacements."""
    c = col(c)
    bare = strip(reduce(lambda x, mark: F.replace(x, F.lit(mark), F.lit("")), S.CURRENCY_MARKS, c))
    return F.when(c.rlike(_NUMBER), c).otherwise(bare)


def known_text(c: Column | str) -> Column:
    """Null for the null-like texts."""
    c = col(c)
    return F.when(~c.isin(S.NULL_STRINGS), c)


def strip_currency(c: Column | str) -> Column:
    """Remove currency and grouping marks, trim, and null the null-like texts."""
    return known_text(bare_number(c))


def parsed(text: Column | str) -> Column:
    """Double of a trimmed text, or null; ``try_cast`` alone would read ``12d``."""
    text = col(text)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_number(c: Column | str) -> Column:
    """Text to double; unreadable, infinite and NaN values become null."""
    return finite(parsed(strip(c)))


def finite(c: Column | str) -> Column:
    """Null for NaN and infinities, so that neither enters the pipeline."""
    c = col(c)
    # NaN is above every number here, so it fails the comparison as well
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, as in ``Post-Graduate``.

    ``initcap`` capitalizes after spaces only, which is the same for plain words.
    """
    c = col(c)
    parts = F.regexp_extract_all(F.lower(c), F.lit(_WORDS), F.lit(1))
    cased = F.transform(
        parts,
        lambda w: F.concat(F.upper(w.substr(F.lit(1), F.lit(1))), w.substr(F.lit(2), F.length(w))),
    )
    return F.when(c.rlike("^[A-Za-z ]*$"), F.initcap(c)).otherwise(F.array_join(cased, ""))


def mapped(c: Column | str, mapping: dict[str, str]) -> Column:
    """Exact-match replacement; values outside the map stay."""
    c = col(c)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), c)


def clip(c: Column | str, low=None, high=None) -> Column:
    """Bounds that keep null as null (``greatest``/``least`` skip nulls)."""
    c = col(c)
    low = low if low is None or isinstance(low, Column) else F.lit(low)
    high = high if high is None or isinstance(high, Column) else F.lit(high)
    if low is None:
        return F.when(c > high, high).otherwise(c)
    bounded = F.when(c < low, low)
    if high is not None:
        bounded = bounded.when(c > high, high)
    return bounded.otherwise(c)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives null on a zero or null denominator."""
    return F.try_divide(col(numerator), col(denominator))


def or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def row_sum(columns) -> Column:
    return reduce(lambda a, b: a + b, [or_zero(c) for c in columns])


def stepped(c: Column | str, steps, otherwise=None) -> Column:
    """First label whose right-closed bound holds the value."""
    c = col(c)
    chain = None
    for bound, label in steps:
        hit = c <= F.lit(float(bound)) if bound is not None else c.isNotNull()
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain if otherwise is None else chain.otherwise(otherwise)


def salary_bracket(c: Column | str) -> Column:
    c = col(c)
    return F.when(c > 0, stepped(c, S.SALARY_BRACKETS))


def in_salary_bracket(c: Column | str, label: str) -> Column:
    c, low = col(c), 0
    for bound, name in S.SALARY_BRACKETS:
        if name == label:
            return (c > low) & (c <= bound) if bound is not None else c > low
        low = bound
    raise KeyError(label)


def credit_band(c: Column | str) -> Column:
    c = col(c)
    return F.when(c >= 0, stepped(c, S.CREDIT_BANDS))


def credit_ordinal(band: Column | str) -> Column:
    band = col(band)
    chain = F.when(band == S.CREDIT_BANDS[0][1], F.lit(0))
    for rank, (_, label) in enumerate(S.CREDIT_BANDS[1:], start=1):
        chain = chain.when(band == label, F.lit(rank))
    return chain.otherwise(F.lit(0))


def zone(p: Column | str) -> Column:
    p = col(p)
    return (F.when(p > S.AUTO_APPROVE, "auto_approve")
            .when(p >= S.AUTO_REJECT, "human_review")
            .otherwise("auto_reject"))


def share(part: Column, whole: Column, places: int | None = None) -> Column:
    """Percentage, null when there is nothing to divide by."""
    pct = F.try_divide(part * F.lit(100.0), whole)
    return F.round(pct, places) if places is not None else pct
