"""Operators for large text corpora: each module holds one operator, `queries` their registered queries."""
