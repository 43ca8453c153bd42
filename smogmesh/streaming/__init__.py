"""Structured Streaming jobs."""

from smogmesh.streaming.feeds import (
    abnormal,
    alerts,
    read_feed,
    read_sensors,
    run_alerts,
    run_separate,
    start_feed,
    with_severity,
    write_sensor_files,
)

__all__ = ["abnormal", "alerts", "read_feed", "read_sensors", "run_alerts", "run_separate", "start_feed", "with_severity", "write_sensor_files"]
