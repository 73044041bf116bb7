"""License rules. Each is a predicate on a free-text license, a code or a URL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted whole codes and accepted fragments of the three rules.
CORE_FRAGMENTS = ["cc0", "pdm", "publicdomain", "public domain", "cc by", "cc-by", "cc_by", "cc by-sa", "cc-by-sa", "cc_by_sa", "attribution", "attribution-sharealike"]
STRICT_CODES = ["by", "by-sa", "cc0", "pdm", "public domain", "publicdomain"]
STRICT_FRAGMENTS = ["cc by", "cc-by", "cc by-sa", "cc-by-sa", "attribution", "public domain", "creativecommons.org/licenses/by/", "creativecommons.org/licenses/by-sa/", "creativecommons.org/publicdomain/"]
OPEN_SET_CODES = ["by", "by-sa"]
OPEN_SET_FRAGMENTS = ["cc0", "pdm", "public domain", "publicdomain", "cc by", "cc-by", "by-sa", "attribution", "creativecommons.org/licenses/by/", "creativecommons.org/licenses/by-sa/", "creativecommons.org/publicdomain/"]
# Restrictions that the fragment rules let through.
RESTRICTED = ["-nc", " nc", "-nd", " nd", "noncommercial", "noderiv"]


def normalize_license(value: Column) -> Column:
    """Lower case, underscores as blanks, runs of white space as one blank; null is empty."""
    low = F.replace(F.lower(F.coalesce(value, F.lit(""))), F.lit("_"), F.lit(" "))
    return F.btrim(F.regexp_replace(low, r"(?U)[\s\x1c-\x1f]+", " "))


def _has_any(text: Column, fragments: list[str]) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(x)) for x in fragments])


def license_is_allowed(value: Column, rule: str = "core", no_restrictions: bool = False) -> Column:
    """Whether a rule ("core", "strict" or "open_set") accepts the license; empty: never.

    The rules look for fragments, so that licenses with a non-commercial or no-derivatives
    clause pass; no_restrictions turns those away.
    """
    text = normalize_license(value)
    accepted = {
        "core": lambda: _has_any(text, CORE_FRAGMENTS),
        "strict": lambda: text.isin(STRICT_CODES) | _has_any(text, STRICT_FRAGMENTS),
        "open_set": lambda: text.isin(OPEN_SET_CODES) | _has_any(text, OPEN_SET_FRAGMENTS),
    }[rule]()
    if no_restrictions:
        accepted = accepted & ~_has_any(text, RESTRICTED)
    return (text != "") & accepted
