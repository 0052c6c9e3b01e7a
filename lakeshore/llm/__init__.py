"""Training-data operators: cleaning, deduplication, scoring, mixing and packing of text.

Every operator takes and returns DataFrames and keeps its own module; the
registered queries live in ``lakeshore.llm.queries``, their SQL in
``lakeshore.llm.oracle``.  Nothing else in the library imports this package.
"""
