"""Datasets staged once per session in the shared scratch folder (text files, partitioned parquet, inputs)."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import SparkSession

from polyscore.session import path_exists, scratch_dir, staging

_LOCKS: dict[str, threading.Lock] = {}
_GUARD = threading.Lock()


def _code_version() -> str:
    """Hash of the package source: datasets staged by other code are never reused."""
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for d, _dirs, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(f.encode())
                    h.update(fh.read())
    return h.hexdigest()[:10]


CODE_VERSION = _code_version()


def staged_path(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> str:
    """Path of a dataset derived from sf_dir, built once by ``build(path)`` (finished = _SUCCESS marker)."""
    tag = hashlib.sha1(f"{sf_dir}|{CODE_VERSION}".encode()).hexdigest()[:10]
    path = f"{scratch_dir(spark).rstrip('/')}/staged/{tag}/{name}"
    with _GUARD:
        lock = _LOCKS.setdefault(path, threading.Lock())
    with lock:
        if not path_exists(spark, f"{path}/_SUCCESS"):
            with staging(spark):
                build(path)
    return path
