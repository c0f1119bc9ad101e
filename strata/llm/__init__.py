"""Training-data operators for text corpora.

Each module holds one operator; ``queries`` registers one thin query per
operator and ``oracles`` the DuckDB SQL where SQL can express it.  Nothing
outside this folder imports it.
"""
