"""Registered queries and the plain SQL that must give the same rows."""
