"""Presentation values: colours, labels, status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonewright.functions.numeric import round_half_away

# District short names.
DISTRICT_SHORT = {
    "Quận 1": "Q1",
    "Quận 3": "Q3",
    "Quận 4": "Q4",
    "Quận 5": "Q5",
    "Quận 7": "Q7",
    "Quận 10": "Q10",
    "Bình Thạnh": "BTh",
    "Gò Vấp": "GV",
    "Tân Bình": "TB",
    "Thủ Đức": "TĐ",
    "Bình Chánh": "BC",
}

# Severity ramp as (r, g, b, alpha); 35 minutes is full red.
FULL_RED_MINUTES = 35.0
GREEN = (16, 185, 129)
YELLOW = (234, 179, 8)
RED = (239, 68, 68)
ALPHA_RANGE = (80, 190)
NO_DATA_COLOUR = (180, 200, 220, 18)

STATUS_COLOUR = {True: "#ef4444", False: "#10b981"}
NO_VALUE = "—"


def severity_colour(delay: Column, has_data: Column) -> dict[str, Column]:
    """fill_r, fill_g, fill_b, fill_a on a green-yellow-red ramp, truncated to int."""
    t = F.least(delay / FULL_RED_MINUTES, F.lit(1.0))
    lower = t * 2.0
    upper = (t - 0.5) * 2.0

    def ramp(channel: int) -> Column:
        low, mid, high = GREEN[channel], YELLOW[channel], RED[channel]
        return F.when(t < 0.5, low + (mid - low) * lower).otherwise(mid + (high - mid) * upper)

    alpha = ALPHA_RANGE[0] + (ALPHA_RANGE[1] - ALPHA_RANGE[0]) * t
    values = [ramp(0), ramp(1), ramp(2), alpha]
    return {
        name: F.when(has_data, value.cast("int")).otherwise(F.lit(blank))
        for name, value, blank in zip(
            ("fill_r", "fill_g", "fill_b", "fill_a"), values, NO_DATA_COLOUR
        )
    }


def delay_label(delay: Column) -> Column:
    return F.format_string("%.1f min avg", delay)


def gap_label(gap: Column) -> Column:
    """``+$1,234 loss``, ``-$1,234 ok`` or a dash."""
    dollars = F.format_number(F.abs(round_half_away(gap, 0)).cast("bigint"), 0)
    return (
        F.when(round_half_away(gap, 0) > 0, F.concat(F.lit("+$"), dollars, F.lit(" loss")))
        .when(round_half_away(gap, 0) < 0, F.concat(F.lit("-$"), dollars, F.lit(" ok")))
        .otherwise(F.lit(NO_VALUE))
    )


def status(is_hotspot: Column) -> Column:
    return F.when(is_hotspot, "HIGH RISK").otherwise("Normal")


def status_colour(is_hotspot: Column) -> Column:
    return F.when(is_hotspot, STATUS_COLOUR[True]).otherwise(STATUS_COLOUR[False])


def gap_class(gap: Column) -> Column:
    return F.when(gap > 0, "Loss").otherwise("Profit")


def district_short(district: Column) -> Column:
    """Short name of a known district, else its first three letters, else a dash."""
    known = F.lit(None).cast("string")
    for name, short in DISTRICT_SHORT.items():
        known = F.when(district == name, short).otherwise(known)
    return F.coalesce(known, F.nullif(F.substring(district, 1, 3), F.lit("")), F.lit(NO_VALUE))


def zone_label(cell: Column, district: Column) -> Column:
    """``Q1·9_39``: district short name and the last four characters of the id."""
    return F.concat(district_short(district), F.lit("·"), F.right(cell, F.lit(4)))


def short_cell(cell: Column) -> Column:
    """First twelve characters and an ellipsis."""
    return F.concat(F.substring(cell, 1, 12), F.lit("…"))
