"""Sources and sinks: the driver-table fixture and file readers/writers."""
