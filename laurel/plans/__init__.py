"""The end-to-end questions, composed from the operators."""
