"""Operations of a training-data pipeline: tokens, quality, language, personal data, neighbours, pages, near and exact repeats, packing."""
