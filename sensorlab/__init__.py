"""sensorlab: sensor analytics and failure prediction as Spark jobs."""

__version__ = "0.1.0"
