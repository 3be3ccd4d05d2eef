"""Training-data operators: decontamination, dedup, formatting, tokenising, toxicity, quality, URLs, shards.

Each module is one operator with its own general interface; ``catalog`` holds the thin
``opN_*`` queries and their SQL. Nothing else in the library imports this subpackage.
"""
