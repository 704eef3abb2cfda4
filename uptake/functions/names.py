"""Header clean-up. Metadata only, plain Python on column names.

Spark's ``initcap`` splits on blanks only, while Python ``str.title`` starts
a new word after any non-letter (``_``), so names are rewritten in Python and
applied with ``toDF``.
"""

from __future__ import annotations

# The substitutions applied to installation-drop headers, in
# the order the original applies them (lower-case first, then these, then
# strip, title-case and removal of underscores).
DROP_HEADER_DELETIONS = ("sum of ", "num_", "kvah", "kva")
DROP_HEADER_RENAMES = (("post_code", "postcode"),)

# Substitutions for indicator headers (lower-case first, then
# these, then title-case, then removal of blanks and underscores).
INDICATOR_HEADER_DELETIONS = ("of measure", "2021")


def normalise_drop_header(name: str) -> str:
    """``Sum of Solar_Capacity_kVA`` -> ``SolarCapacity``; ``post_code`` -> ``Postcode``."""
    out = name.lower()
    for token in DROP_HEADER_DELETIONS:
        out = out.replace(token, "")
    for old, new in DROP_HEADER_RENAMES:
        out = out.replace(old, new)
    return out.strip().title().replace("_", "")


def normalise_indicator_header(name: str) -> str:
    """``Unit of Measure`` -> ``Unit``; ``LGA_2021`` -> ``Lga``; ``TIME_PERIOD`` -> ``TimePeriod``."""
    out = name.lower()
    for token in INDICATOR_HEADER_DELETIONS:
        out = out.replace(token, "")
    return out.title().replace(" ", "").replace("_", "")


def rename_columns(df, mapper):
    """Apply a name function to every column (metadata only, no job)."""
    return df.toDF(*[mapper(c) for c in df.columns])
