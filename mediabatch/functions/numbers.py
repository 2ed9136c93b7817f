"""Number formatting for report rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def round2(x: pd.Series) -> pd.Series:
    """Two decimals with the report's own rounding (exact ties of the binary value go to even).

    Used only on report rows, of which there is one per day or per table.
    """
    return x.map(lambda v: round(v, 2), na_action="ignore")
