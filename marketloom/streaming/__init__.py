"""Streaming queries of each layer, and the runner that keeps a layer together."""
