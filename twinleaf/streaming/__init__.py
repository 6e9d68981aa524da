"""Verdicts that keep arriving: a file stream of the exchange folder."""
