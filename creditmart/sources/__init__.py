"""Sources and sinks: raw extracts, partitioned tables, role views."""
