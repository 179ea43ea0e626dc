"""Panel analytics for search-content data, expressed as Spark DataFrame operators.

Every public function takes and returns DataFrames (or Columns) and stays lazy;
the few that must write say so in their name.
"""

__version__ = "0.1.0"
