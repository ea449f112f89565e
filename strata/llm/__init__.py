"""Training-data operators: deduplication, decontamination, language and
toxicity models, secret scans, token rollups and subword encoding.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries over the given tables; each other module is one operator.
"""
