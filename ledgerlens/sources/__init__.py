"""Sources (adapter over the test tables, CSV and JSON scans) and sinks."""
