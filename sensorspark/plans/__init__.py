"""The three end-to-end flows: prepare, train, score."""
