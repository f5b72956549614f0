"""Presets: raw schemas, cleaning rules and layer-to-layer stages of the three data sets."""
