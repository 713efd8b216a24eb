"""Training-data operators: documents in, tables out."""
