"""Spark table and stream operators for applied data science.

Every operator is a plain function from DataFrame to DataFrame (or from Column to
Column) for use with ``df.transform``; nothing here holds global state.
"""
