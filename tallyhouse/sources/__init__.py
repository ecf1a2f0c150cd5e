"""Scans, sinks, model artefacts and the views over the test tables."""
