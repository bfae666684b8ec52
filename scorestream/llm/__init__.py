"""Training-data operators and the corpus pipeline's stages.

Nothing else in the library imports this subpackage.  Operators take DataFrames
and column names and return DataFrames; ``queries`` applies them to the tables.
"""
