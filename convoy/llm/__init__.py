"""Operators for preparing language-model training text, one module each.

Nothing else in the package imports this subpackage; ``queries`` holds what the entry file
registers.  Every operator takes DataFrames and column names, selects the columns it needs by
position in its own namespace (so extra or clashing columns of the input never matter) and cuts
lineage only through tables under the session's shared checkpoint folder.
"""
