"""Event-time analytics for keyed JSON telemetry, written as plain Spark transforms."""
