"""Operators for training-data pipelines over the tables documents, pages,
conversations, benchmark and labels. Nothing else in the library imports this
subpackage.

Conventions that hold for every operator here:

* operators read only the columns they name (``doc_id``, ``text`` ...) and
  return a schema of their own, so extra input columns with clashing names
  cannot reach them;
* a null text counts as the empty text; a null id stays null;
* an empty table gives an empty result of the same schema;
* intermediate tables are written below ``spark.checkpoint.dir`` and survive a
  lost executor.
"""
