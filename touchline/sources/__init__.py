"""Sources (scans, schemas, the driver-table adapter) and sinks."""
