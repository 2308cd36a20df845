"""Text sanitizing for metadata strings.

Line breaks become spaces, accents are separated from their letters (NFD) and
dropped with every other non-ASCII code point, runs of spaces collapse to one
and white space at the ends goes. Spark has no Unicode normalization, so that
one step is an Arrow UDF over whole series; it gets only the values that have
a non-ASCII character. Everything else is SQL functions.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's code with the UDF (pickled by value): Python workers need
# no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(T.StringType())
def _ascii_udf(s: pd.Series) -> pd.Series:
    decomposed = s.str.normalize("NFD").str.encode("ascii", "ignore").str.decode("ascii")
    return decomposed.astype(object).where(s.notna(), None)


def sanitize_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    one_line = F.regexp_replace(c, "[\n\r\u2028\u2029]+", " ")
    accented = _ascii_udf(F.when(one_line.rlike(r"[^\x00-\x7F]"), one_line))
    squeezed = F.regexp_replace(F.coalesce(accented, one_line), " +", " ")
    return F.regexp_replace(squeezed, r"^[\x09-\x0D\x1C-\x20]+|[\x09-\x0D\x1C-\x20]+\z", "")
