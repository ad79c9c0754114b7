"""Operations of a training-data pipeline: filters, deduplication, scans and encodings.

Nothing else in the library imports this package.  ``queries`` lists the registered
queries, ``corpus_pipeline`` at the repository top chains five of the operators.
"""
