"""Business rules shared by operators and models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Driver cost in USD per hour.
VAN_HOURLY = 5.0
OTHER_HOURLY = 3.0

# A delivery later than this is delayed; a zone whose mean exceeds it is a hotspot.
DELAY_THRESHOLD = 15


def is_delayed() -> Column:
    return F.col("delay_minutes") > DELAY_THRESHOLD
