"""Operators on label volumes: codecs, volumes, label statistics, planning, verification, telemetry, calibration."""
