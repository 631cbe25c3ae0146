"""Reading and writing records."""
