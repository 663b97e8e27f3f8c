"""Dictionary normalisers: vendor catalog extracts to one common dictionary.

Every normaliser takes catalog extracts as DataFrames (read over JDBC or from files)
and returns rows of the common dictionary without snapshot columns; see
:mod:`tabscope.operators.dictionary.common` for the shapes. The list of schemas to
keep is a list of names, never SQL text.
"""
