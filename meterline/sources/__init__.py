"""Sources and sinks: provided tables, the trip fixture, the zone dimension,
and layer materialisation."""

from meterline.sources.fixture import raw_zones, table, trips_from_lineitem
from meterline.sources.sinks import materialize, register_table, table_properties
from meterline.sources.zones import SizedDimension, sized_zones, zone_dimension

__all__ = [
    "raw_zones", "table", "trips_from_lineitem",
    "materialize", "register_table", "table_properties",
    "SizedDimension", "sized_zones", "zone_dimension",
]
