"""Sources and sinks: log scans, catalog tables, delimited text, SQL views."""
