"""docsynth: synthetic filled-form datasets as Spark DataFrame operators.

Every step is a DataFrame -> DataFrame operator (or a Column function):
template annotations are read as tables, expanded into documents, filled
with reproducible keyed-hash random values, assembled into ground-truth
records, laid out as glyphs, grouped into words and written as label lines,
with a per-document augmentation plan alongside.
"""

__version__ = "0.1.0"
