"""Sources and sinks: tables, snapshots, pages, and versioned publication."""
