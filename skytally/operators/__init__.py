"""Decoding and windowing transforms (DataFrame in, DataFrame out)."""
