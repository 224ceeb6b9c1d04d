"""Composed jobs: raw -> clean, clean -> aggregates, the quality report and
the whole layered run."""

from meterline.plans.layers import LayerRun, read_layer, run_layers
from meterline.plans.quality import quality_report
from meterline.plans.silver import clean_core, clean_trips, typed_trips, valid_trips

__all__ = ["LayerRun", "read_layer", "run_layers", "quality_report", "clean_core", "clean_trips",
           "typed_trips", "valid_trips"]
