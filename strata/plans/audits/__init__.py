"""Semantic audits per business domain. Each entry takes the typed tables and the cut-off day and returns
a small frame; the tables are always read whole. Children are folded to (key, date) counts before they
meet their parents, so a parent with very many children costs few rows in the join."""
