"""Operations of a training-data pipeline: fingerprints, filters, scans, deduplication, tokenizing.

Nothing else in the library imports this subpackage.
"""
