"""Structured Streaming: query start helpers, triggers, progress, quarantine."""
