"""Reading operational data and finding what changed."""
