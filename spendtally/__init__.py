"""Find under-reported supplier spend with Spark.

Contracts are linked to spend reports ("MI") on supplier key and buyer name;
contracts without reported spend are flagged.  Every public function takes and
returns lazy DataFrames (or Columns), and every date comparison takes an
explicit ``as_of``.
"""

__version__ = "0.1.0"
