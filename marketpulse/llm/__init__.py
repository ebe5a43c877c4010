"""Training-data pipeline operators over documents, vectors and conversations."""
