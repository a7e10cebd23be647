"""Training-data operators: cleaning, matching, labelling, packing and archiving of text.

Nothing else in the library imports this subpackage.  Its queries are in
:mod:`gridloom.llm.queries`; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
