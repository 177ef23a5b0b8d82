"""File catalogue, table readers and writers."""
