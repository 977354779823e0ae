"""Operators of a training-data pipeline, one module each.

Every operator takes DataFrames and returns DataFrames.  Two conventions hold
throughout.  A document is a row: rows that share a doc_id but differ in text
are told apart by a hash of the text, rows repeated in full give equal results
once per row, and a null doc_id is a value like any other.  Only the named id
and text columns are read, so further columns of any name do not matter.
"""
