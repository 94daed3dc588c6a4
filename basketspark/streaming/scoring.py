"""Live segment scoring: validate and score requests as they arrive.

Both steps are projections over literals, so a streaming frame takes them as is
and no state, watermark or shuffle is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.operators.segment import Scaler, rfm_validate, segment_assign


def score_requests(requests: DataFrame, scaler: Scaler, centroids: list[tuple[float, ...]], names: list[str]) -> DataFrame:
    """Valid requests scored; invalid ones kept with their reason and no segment."""
    checked = rfm_validate(requests)
    scored = segment_assign(checked, scaler, centroids, names)
    valid = F.col("rejected_because").isNull()
    return scored.select(
        *[c for c in checked.columns],
        *[F.when(valid, F.col(c)).alias(c) for c in ("segment_id", "segment_name", "distance_to_centroid", "interpretation")],
    )
