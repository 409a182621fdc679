"""Column idioms: every function takes columns and returns a column, all JVM-side."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that count as TRUE after trimming and lower-casing.
TRUE_WORDS = ("true", "t", "1", "y", "yes")

# Fixed value: what a NULL part contributes to a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c: Column | str) -> Column:
    """TRUE for the usual spellings of yes, FALSE for everything else including NULL."""
    return F.coalesce(F.lower(F.trim(_col(c).cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def is_true(c: Column | str) -> Column:
    """TRUE only where the flag is TRUE; NULL counts as FALSE."""
    return F.coalesce(_col(c), F.lit(False))


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def proper_case(c: Column | str) -> Column:
    """First letter of every space-separated word upper, the rest lower; blank is NULL."""
    return F.initcap(blank_to_null(c))


def email_in_domain(c: Column | str, domain: str) -> Column:
    """Whether the text after the first ``@`` is ``domain``; NULL for a NULL address."""
    return F.lower(F.split_part(_col(c), F.lit("@"), F.lit(2))) == F.lit(domain.lower())


def timestamp_of(c: Column | str, lenient: bool = False) -> Column:
    """Parse a timestamp. Malformed text fails the query, or becomes NULL when lenient."""
    return _col(c).try_cast("timestamp") if lenient else _col(c).cast("timestamp")


def fallback_key(preferred: Column | str, parts: Mapping[str, Column]) -> Column:
    """``preferred`` unless blank, else the parts joined by ``|``.

    ``parts`` maps the placeholder used for a missing part to the part itself.
    """
    texts = [F.coalesce(part.cast("string"), F.lit(gap)) for gap, part in parts.items()]
    return F.coalesce(blank_to_null(preferred), F.concat_ws("|", *texts))


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 digest over the parts, with a marker in place of NULL parts."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def positive_amount(c: Column | str, dtype: str) -> Column:
    """Whether the amount, read at the precision of ``dtype``, is above zero.

    Unreadable, overflowing and missing amounts count as zero.
    """
    return F.coalesce(_col(c).try_cast(dtype), F.lit(0).cast(dtype)) > 0


def contains_any(c: Column | str, words: Iterable[str]) -> Column:
    """Whether the upper-cased text contains any of the (upper-case) words; FALSE for NULL."""
    text = F.upper(F.coalesce(_col(c), F.lit("")))
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def in_list(c: Column | str, values: Iterable[str]) -> Column:
    """Membership test that is FALSE, not NULL, for NULL."""
    return F.coalesce(_col(c).isin(*values), F.lit(False))


def relabel(c: Column | str, labels: Mapping[tuple[str, ...], str], default: Column | None) -> Column:
    """Replace the values listed in each tuple by its label; other values give ``default``."""
    ladder = None
    for values, label in labels.items():
        test = _col(c).isin(*values)
        ladder = F.when(test, label) if ladder is None else ladder.when(test, label)
    return ladder if default is None else ladder.otherwise(default)
