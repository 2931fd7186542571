"""Live-cell track analytics as Spark jobs: label planes in, tracks, summaries and dose curves out."""

__version__ = "0.1.0"
