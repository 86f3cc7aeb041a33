"""Structured Streaming: incremental intake of landed payloads."""

from barsmith.streaming.intake import IntakeReport, intake, intake_files, read_intake

__all__ = ["IntakeReport", "intake", "intake_files", "read_intake"]
