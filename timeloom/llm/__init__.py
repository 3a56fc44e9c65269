"""Training-data operators: ten corpus operators for tables of documents and pages.

Nothing else in the library imports this subpackage; its queries are listed in
``timeloom.llm.registry``.
"""
