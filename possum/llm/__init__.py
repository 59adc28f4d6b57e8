"""Training-data operators.

One module per operator, ``queries.py`` with the registered ``opN_`` queries
and ``oracle.py`` with their DuckDB SQL. Nothing outside this package imports
it. See the README section "Training-data operators".
"""
