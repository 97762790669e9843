"""Event time, watermarks and running queries."""
