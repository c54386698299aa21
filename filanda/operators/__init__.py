"""Operators on tables: snapshots, ledgers, similarity graphs, publishing and audits."""
