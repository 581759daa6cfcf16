"""Sources: topic and file readers, the test-data adapter, stored-table scans."""
