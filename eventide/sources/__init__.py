"""Sources: test tables, the sensor view, text lines, generators, queues."""

from eventide.sources.tables import TABLES, table  # noqa: F401
from eventide.sources.sensor import (  # noqa: F401
    SENSOR_SCHEMA, arrival_view, sensor_view,
)
