"""casekit: case-operations analytics (staging, timings, fact, marts, reports) on Spark."""

__version__ = "0.1.0"
