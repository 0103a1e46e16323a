"""Sources: driver tables, derived fixtures, file readers and writers."""
