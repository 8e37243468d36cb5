"""Whole jobs put together from the operators: the daily run and the registered queries."""
