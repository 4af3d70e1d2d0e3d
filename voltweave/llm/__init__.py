"""Training-data operators: similarity joins, search, token output, decontamination, scoring, packing.

Every module holds one operator with its general interface; ``catalog`` holds the registered queries.
"""
