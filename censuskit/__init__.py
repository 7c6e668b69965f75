"""censuskit: facility-census analytics as composable Spark DataFrame jobs."""

__version__ = "0.1.0"
