"""Sources and sinks: test-data views, export scans, history snapshots, landing files."""
