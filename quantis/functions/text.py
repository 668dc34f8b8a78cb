"""String column builders.

Every builder returns a ``Column`` made only of built-in Spark SQL
functions, so it stays inside whole-stage codegen and never leaves the
JVM.  The semantics follow the R string helpers the reports rely on;
the differences from Spark's defaults are noted per function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values (must equal the reference for identical results):
# - the category-label cleaner removes, in this order, the first ".", the
#   first digit, then the first "0", "1" and "2";
# - org-unit display names lose the first " County" or " Sub County";
# - hierarchy levels lose every " Ward" and every " Sub County".
LABEL_CLEANER_SEQUENCE = (".", "[0-9]", "0", "1", "2")
ORG_SUFFIX_PATTERN = " County| Sub County"
WARD_SUFFIX = " Ward"
SUB_COUNTY_SUFFIX = " Sub County"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_first(c: ColumnOrName, pattern: str) -> Column:
    """Delete only the first (leftmost) match of ``pattern``.

    ``regexp_replace`` rewrites every match; anchoring a lazy prefix to the
    start of the string and putting it back keeps later matches intact.
    ``pattern`` is a Java regex; alternations keep their leftmost-first
    meaning (e.g. ``" County| Sub County"``).
    """
    return F.regexp_replace(_col(c), r"(?s)^(.*?)(?:" + pattern + ")", "$1")


def remove_first_literal(c: ColumnOrName, literal: str) -> Column:
    """Delete the first occurrence of a fixed string (no regex)."""
    x = _col(c)
    pos = F.instr(x, literal)
    head = x.substr(F.lit(1), pos - 1)
    tail = x.substr(pos + len(literal), F.lit(2**31 - 1))
    return F.when(pos > 0, F.concat(head, tail)).otherwise(x)


def remove_all(c: ColumnOrName, literal: str) -> Column:
    """Delete every occurrence of a fixed string."""
    return F.replace(_col(c), F.lit(literal), F.lit(""))


def clean_tab(c: ColumnOrName = "tab", strict: bool = False) -> Column:
    """Category label cleaner.

    Default (``strict=False``) reproduces the reference cleaner exactly:
    in sequence it deletes the first ``.``, then the first digit, then the
    first ``0``, the first ``1`` and the first ``2``.  ``10.Physiotherapy``
    becomes ``Physiotherapy`` but ``13.Oncology`` becomes ``3Oncology``.
    ``strict=True`` removes only a leading ``<digits>.`` prefix, which is
    what the labels evidently intend.
    """
    x = _col(c)
    if strict:
        return F.regexp_replace(x, r"^[0-9]+\.", "")
    first, *rest = LABEL_CLEANER_SEQUENCE
    x = remove_first_literal(x, first)
    for ch in rest:
        # ``^([^d]*)d`` is the first occurrence of d; linear time, no
        # backtracking blow-up on long labels.
        neg = "[^0-9]" if ch == "[0-9]" else "[^" + ch + "]"
        x = F.regexp_replace(x, "^(" + neg + "*)" + ch, "$1")
    return x


def title_case(c: ColumnOrName) -> Column:
    """ICU title-casing: ``tharaka-nithi`` -> ``Tharaka-Nithi``.

    Plain ``initcap`` only capitalises after spaces; under the ``UNICODE``
    collation Spark applies ICU word breaks, matching stringr.
    """
    return F.initcap(F.collate(_col(c), "UNICODE")).cast("string")


def county_key(c: ColumnOrName) -> Column:
    """Case-folded county name used to compare a column with a parameter."""
    return F.lower(F.trim(_col(c)))


def strip_org_suffix(c: ColumnOrName) -> Column:
    """Org-unit display name -> plain name: drop the first `` County`` or
    `` Sub County`` (first match only) and trim."""
    return F.trim(remove_first(c, ORG_SUFFIX_PATTERN))


def detect(c: ColumnOrName, pattern: str) -> Column:
    """Regex containment test, case-sensitive (``str_detect``)."""
    return _col(c).rlike(pattern)
