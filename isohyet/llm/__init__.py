"""Training-data operators: packing, decontamination, deduplication, scoring, extraction."""
