"""Training-data operators: quality, near-duplicate, decontamination, privacy, mixing and output."""
