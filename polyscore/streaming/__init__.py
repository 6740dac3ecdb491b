"""Incremental ingest with Structured Streaming.

The study converts each phenotype's clump output as its job finishes.
Here the folder of clump text files is a file stream: every new file is
parsed (stateless) and appended exactly once to a parquet table; the
stream's checkpoint lives in the shared scratch folder.
"""
