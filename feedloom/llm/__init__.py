"""Training-data operators: quality, toxicity, pieces, HTML, licences, media, PII, decontamination, dedup, chat."""
