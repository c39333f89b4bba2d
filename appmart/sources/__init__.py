"""Sources and sinks: fixed-schema CSV scans, table storage, test-data adapters."""
