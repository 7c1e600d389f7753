"""Unicode normalisation, which no built-in function has, in Arrow batches."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility normalisation: full-width letters, ligatures and the like to the plain ones; nulls stay."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))
