"""Row encoders and the writers that carry encoded rows away."""
