"""Streaming jobs. Offsets and state live in the checkpoint; results are written repeat-safe."""
