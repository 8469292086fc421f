"""The given tables cast as mart inputs, and one query per operator."""
