"""Operators: DataFrame -> DataFrame building blocks of the study's plans."""
