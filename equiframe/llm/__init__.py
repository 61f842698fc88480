"""Training-data operators on Spark: archives, mixing, toxicity, quality
rules, secret scans, similarity joins, decontamination, token files, sharding
and language-model scoring.  Nothing else in the library imports this
subpackage; ``queries`` holds the registered queries and their SQL.
"""
