"""Sources and sinks: the file-backed log, Kafka options, test-table views."""
