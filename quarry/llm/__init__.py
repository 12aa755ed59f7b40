"""Operations of a training-data pipeline: deduplication, filters, classifiers, tokenising, packing.

Nothing else in the library imports this package.
"""
