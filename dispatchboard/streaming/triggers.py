"""Trigger settings by name (STR-2)."""

from __future__ import annotations


def trigger_kwargs(trigger: str) -> dict:
    """"availableNow" drains what is there and stops (tests, scheduled pulls);
    "once" is one batch; anything else is a processing-time interval such as
    "10 seconds" (the reference's trigger) or "30 minutes" (the table poll)."""
    if trigger == "availableNow":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}
