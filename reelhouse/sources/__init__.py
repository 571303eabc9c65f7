"""Sources and sinks: CSV scans, driver-table fixtures, gold writes, audit."""
