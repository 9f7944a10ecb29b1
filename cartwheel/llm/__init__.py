"""Operators for preparing language-model training corpora.

Ten operators over the ``documents``, ``benchmark``, ``labels`` and
``conversations`` tables, each a Spark job of its own; ``queries`` registers
them and ``corpus_pipeline.py`` at the repository top chains five of them.
Nothing outside this subpackage imports it.
"""
