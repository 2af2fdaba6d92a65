"""Compositions of operators: the marts, the batch run, the query catalog."""
