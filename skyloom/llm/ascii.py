"""Text rules that go no further than ASCII, as column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of ASCII: tab to carriage return, and space.
BLANKS = " \t\n\x0b\x0c\r"


def fold_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does that alone where all is ASCII."""
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)


def strip_ascii(text: Column) -> Column:
    """The text without white space of ASCII at both ends."""
    return F.btrim(text, F.lit(BLANKS))
