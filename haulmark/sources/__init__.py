"""Reading tables and writing results."""
