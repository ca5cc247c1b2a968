"""Sources and sinks: test-table views, delimited text, rejects, text sink."""
