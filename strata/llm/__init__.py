"""Operations of a training-data pipeline: search, deduplication, filters, tokens, packing."""
