"""Sources and sinks: bronze landing, driver-table views, schemas, writers."""
