"""Readers for the CSV inputs, and Parquet stage tables."""

from tripmetrics.sources.csv_tables import (
    broken_records,
    read_trips,
    read_weather,
    read_zips,
    record_summary,
    unreadable_fields,
    whole_records,
)
from tripmetrics.sources.stages import Stages, load_stage, remove_stage, save_stage, scratch_path, stage

__all__ = [
    "Stages",
    "broken_records",
    "load_stage",
    "read_trips",
    "read_weather",
    "read_zips",
    "record_summary",
    "remove_stage",
    "save_stage",
    "scratch_path",
    "stage",
    "unreadable_fields",
    "whole_records",
]
