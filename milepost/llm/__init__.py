"""Training-data operators: counting, extraction, search, decontamination, deduplication, sharding, scoring.

Each module holds one operator built on Spark DataFrames; ``queries`` applies
them to the whole tables. Nothing else in the library imports this package.
"""
