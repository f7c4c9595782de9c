"""Compositions of the operators: the query catalog, the SQL oracle and the end-to-end audit run."""
