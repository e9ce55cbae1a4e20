"""Compositions of the operators: the model graph and the whole run."""
