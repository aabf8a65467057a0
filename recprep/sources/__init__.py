"""Sources and sinks (A1-A10)."""
