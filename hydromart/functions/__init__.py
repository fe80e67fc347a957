"""Column expressions (all built-in Spark functions, evaluated in the JVM)."""

from hydromart.functions.codes import (
    bool_to_int, clean, department_code, distinct_from, first_present, identity_hash,
    int_text, is_blank, pad_code, place_key, safe_cast, safe_ratio, strip_marks, valid_label_row,
)
from hydromart.functions.spatial import (
    EARTH_RADIUS_M, chord_for_arc, grid_cell, haversine_m, neighbour_cells, unit_xyz,
)
from hydromart.functions.temporal import (
    as_date, as_timestamp, calendar_parts, day_gap, sentinel_date, sunday_week,
)

__all__ = [
    "bool_to_int", "clean", "department_code", "distinct_from", "first_present", "identity_hash",
    "int_text", "is_blank", "pad_code", "place_key", "safe_cast", "safe_ratio", "strip_marks",
    "valid_label_row", "EARTH_RADIUS_M", "chord_for_arc", "grid_cell", "haversine_m",
    "neighbour_cells", "unit_xyz", "as_date", "as_timestamp", "calendar_parts", "day_gap",
    "sentinel_date", "sunday_week",
]
