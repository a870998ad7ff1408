"""Batch analytics over fleets of sensors, written as Spark DataFrame plans."""

from vanescope.spec import TURBINE, SeriesSpec

__all__ = ["TURBINE", "SeriesSpec"]
