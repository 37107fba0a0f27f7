"""Reading and writing: append-only JSON lines, REST endpoints, partitioned tables, reports."""
