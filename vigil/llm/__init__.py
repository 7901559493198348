"""Operations of a training-data pipeline (quality, toxicity, packing, WARC,
page text, secrets, chat format, near-duplicates, line dedup, decontamination)."""
