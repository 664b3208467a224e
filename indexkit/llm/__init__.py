"""Training-data operators: packing, tokenisation, search, quality, chat
formatting, URL rules, LM scoring, deduplication and language identification.

Each operator lives in its own module with a general interface; ``queries``
registers one production query per operator.  Nothing outside this subpackage
(but the guarded import in ``__spark_entry__`` and ``corpus_pipeline``)
imports it.
"""
