"""Reading from and writing to storage."""
