"""The session fixture comes from the folder above."""
