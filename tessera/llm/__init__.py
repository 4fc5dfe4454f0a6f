"""Operators of a training-data pipeline: quality, search, near-duplicates,
language-model scores, token counts, decontamination, mixing, URL rules,
personal data and line dedup.  Nothing else in the library imports this package."""
