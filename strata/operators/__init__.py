"""DataFrame operators: cleaning, upserts, dimensions, timelines and measures."""
