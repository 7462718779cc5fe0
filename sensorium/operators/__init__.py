"""Relational operators, alert rules, hierarchy build and the measure layer."""
