"""Streaming entry points (the reference itself has no streaming code; see
:mod:`.scenario_stream` for the re-aimed interactive scoring)."""
