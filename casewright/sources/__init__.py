"""Readers and writers: tickets, labels, predictions, vector index, checkpoint partials, metrics."""
