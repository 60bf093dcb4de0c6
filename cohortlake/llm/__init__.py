"""Operations of a training-data pipeline: mixing, packing, counting, search, extraction, deduplication, filters."""
