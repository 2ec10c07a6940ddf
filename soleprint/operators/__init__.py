"""Operators over DataFrames. Each works on whole inputs and returns a lazy DataFrame."""
