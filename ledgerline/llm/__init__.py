"""Training-data operators: one module per operator, all on Spark DataFrames.

Nothing else in the library imports this subpackage. ``queries`` registers
one query per operator; ``corpus_pipeline.py`` at the repository root chains
five of them.
"""
