"""Training-data operators: secrets, packing, decontamination, top-k, licences, near-dups, quality, PII, toxicity, lines."""
