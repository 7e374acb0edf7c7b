"""Point geometry as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_BUFFER_METRES = 100
MAX_BUFFER_METRES = 500


def point_text(lon: Column, lat: Column) -> Column:
    return F.format_string("POINT(%s %s)", lon.cast("string"), lat.cast("string"))


def checked_buffer(metres: int) -> int:
    if metres > MAX_BUFFER_METRES:
        raise ValueError(f"point buffer must be <= {MAX_BUFFER_METRES} metres, got {metres}")
    return int(metres)
