"""Stages of one load: the only code that writes tables and runs jobs on its own."""
