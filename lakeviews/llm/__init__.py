"""Training-data operators (mixing, decontamination, classifiers, scans, de-duplication).

Nothing else in the library imports this package.  Operators live one per
module; ``registry`` holds the queries and their SQL.
"""
