"""assayweave: a PySpark-native engine for literature-derived measurement data.

Core operators live in :mod:`assayweave.operators`, column functions in
:mod:`assayweave.functions`, readers and writers in :mod:`assayweave.sources`,
the query registry in :mod:`assayweave.plans`.  The optional subpackage
``assayweave.llm`` is imported by nothing else.
"""

__version__ = "0.1.0"
