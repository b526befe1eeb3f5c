"""Operators for preparing language-model training data.

One module per operator, ``common`` for what they share, ``queries`` for the
registered ``opN_*`` queries. Nothing outside this folder imports it except
the guarded import in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
