"""Training-data operators: extraction, archives, tokens, packing, language models, duplicates, contamination, toxicity.

Each module holds one operator with its own general interface; ``queries`` registers the thin queries over the given
tables.  Nothing else in the library imports this subpackage.
"""
