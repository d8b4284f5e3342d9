"""Readers: landing files, telemetry, logs and documents."""
