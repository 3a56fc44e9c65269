"""Readers and writers of the tables that recordings, scripts and edit lists come in."""
