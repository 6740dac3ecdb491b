"""Composite plans: the study's end-to-end jobs as single DataFrame plans."""
