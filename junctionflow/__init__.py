"""junctionflow: road-sensor analytics on Spark (stream + nightly batch + reports)."""

__version__ = "0.1.0"
