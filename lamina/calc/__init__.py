"""Declared calculation engines: named formulas with provenance, gates and a verdict."""
