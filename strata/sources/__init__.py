"""Inputs: landed pages, file manifests, envelopes, layer partitions, run results."""
