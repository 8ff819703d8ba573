"""Operators for preparing training text at scale (one module per operator).

Nothing outside this package imports it; `queries.py` lists what the driver
registers and `corpus_pipeline.py` at the repository top chains five of them.
"""
