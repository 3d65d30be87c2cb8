"""Sources and sinks: tables, paths, exports."""
