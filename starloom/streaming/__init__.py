"""Incremental loads as streams (:mod:`starloom.streaming.incremental`)."""
