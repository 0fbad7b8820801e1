"""Operators for preparing training corpora: deduplication, filtering, privacy, decontamination, mixing."""
