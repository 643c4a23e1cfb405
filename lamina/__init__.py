"""Lamina: tabulated engineering data and corpora as Spark plans."""
