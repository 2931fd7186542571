"""Declared schemas of the relations that cross a boundary."""

from __future__ import annotations

PLANES = "movie_id string, stack string, frame int, height int, width int, pixels array<double>"
DETECTIONS = "movie_id string, frame int, label int, x int, y int, area double, eccentricity double, `bbox-0` int, `bbox-1` int, `bbox-2` int, `bbox-3` int"
WELLMAP = "celltype string, transfection string, drug string, well_ids string"
SUMMARY = "particle bigint, track_length bigint, max_displacement double, mito_start bigint, cell_area double, mitosis double"
EXPERIMENT = SUMMARY + ", well string, position string, storage_location string, code string"
