"""Operators that prepare text and paired records for model training. Nothing outside this subpackage imports it."""
